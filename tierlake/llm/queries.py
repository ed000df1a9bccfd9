"""Registered queries of the operators in this package, and their SQL where it can be said."""

import re

from pyspark.sql import functions as F

from tierlake.llm import audit, caps, chat, codes, extract, mixing, packing, quality, secrets, simhash, substrings, toxicity, urls
from tierlake.llm.common import Scratch, configure, read

QUERIES = {}
SQL = {}


def query(name, sql=None):
    """Register the decorated ``f(spark, sf_dir)`` and its SQL, if there is any."""

    def register(function):
        def configured(spark, sf_dir):
            return function(configure(spark), sf_dir)

        QUERIES[name] = configured
        if sql:
            SQL[name] = sql.strip()
        return function

    return register


# --- 1 quality rules -----------------------------------------------------------

WORD = r"[^\x20\x09-\x0D]+"
RULE_SQL = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
}
TESTS_SQL = ",\n".join(
    f"('{rule}', {order}, CAST({cutoff} AS DOUBLE))"
    for rule, values in quality.CUTOFFS.items() for order, cutoff in enumerate(values))
METRICS_SQL = "\n  UNION ALL ".join(
    f"SELECT doc_id, lang, '{rule}' AS rule, CAST({expr} AS DOUBLE) AS metric FROM base "
    "WHERE NOT base_failed" for rule, expr in RULE_SQL.items())


@query("op1_quality_rules", f"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
tokens AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM texts),
windows AS (
  SELECT doc_id, i, w, lead(w, 1) OVER d AS w2, lead(w, 2) OVER d AS w3
  FROM tokens WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
again AS (
  SELECT doc_id, i FROM windows WHERE w3 IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, w, w2, w3) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(3) AS s(k) GROUP BY doc_id),
line_rows AS (SELECT doc_id, unnest(lines) AS line FROM texts),
dup_lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM line_rows
  WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
base AS (
  SELECT t.doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
         len(words) < {quality.MIN_WORDS}
           OR 100 * coalesce(c.n, 0) > {quality.REPEAT_PERCENT} * len(words) AS base_failed
  FROM texts t LEFT JOIN covered c ON t.doc_id = c.doc_id LEFT JOIN dup_lines l ON t.doc_id = l.doc_id),
metrics AS (
  {METRICS_SQL}),
tests(rule, turn, cutoff) AS (VALUES
{TESTS_SQL}),
judged AS (SELECT doc_id, min(quality) = 1 AS good FROM labels GROUP BY doc_id),
hits AS (
  SELECT m.doc_id, lang, m.rule, turn, cutoff, good, metric > cutoff AS hit
  FROM metrics m JOIN judged USING (doc_id) JOIN tests t ON m.rule = t.rule),
tallies AS (
  SELECT lang, turn, count(*) FILTER (WHERE good) AS n, count(*) FILTER (WHERE good AND hit) AS k
  FROM (SELECT doc_id, lang, turn, good, bool_or(hit) AS hit FROM hits GROUP BY doc_id, lang, turn, good)
  GROUP BY lang, turn),
sizes AS (
  SELECT n, row_number() OVER (ORDER BY n DESC) AS place FROM tallies WHERE turn = 0),
able AS (SELECT max(place) AS strata FROM sizes WHERE pow(1 - {quality.RISK}, n) <= {quality.DELTA} / place),
bounds AS (
  SELECT *, CASE WHEN k >= {quality.RISK} * n THEN 1.0 ELSE list_sum(list_transform(
    range(k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
      + i * ln({quality.RISK}) + (n - i) * ln(1 - {quality.RISK})))) END AS p
  FROM tallies),
proven AS (
  SELECT lang, turn
  FROM (SELECT *, bool_and(p <= {quality.DELTA} / (SELECT strata FROM able)) OVER (PARTITION BY lang ORDER BY turn) AS ok
        FROM bounds)
  WHERE ok),
chosen AS (
  SELECT h.lang, rule, cutoff
  FROM hits h JOIN proven p ON h.turn = p.turn AND h.lang IS NOT DISTINCT FROM p.lang
  GROUP BY h.lang, rule, h.turn, cutoff
  HAVING count(*) FILTER (WHERE hit AND NOT good) > count(*) FILTER (WHERE hit AND good)
  QUALIFY row_number() OVER (PARTITION BY h.lang, rule ORDER BY
    count(*) FILTER (WHERE hit AND NOT good) - count(*) FILTER (WHERE hit AND good) DESC, h.turn) = 1),
rejected AS (
  SELECT DISTINCT m.doc_id FROM metrics m
  JOIN chosen c ON m.rule = c.rule AND m.lang IS NOT DISTINCT FROM c.lang WHERE metric > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM base""")
def _(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    scratch = Scratch(spark)
    measured = scratch.write(quality.measure(docs).drop("text"), "measured")
    labels = read(spark, sf_dir, "labels", "doc_id", "quality")
    cutoffs = scratch.write(quality.calibrate(measured, labels), "cutoffs")
    return quality.judge(measured, cutoffs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


# --- 4 SimHash near-duplicates -------------------------------------------------


@query("op4_simhash_near_dedup")
def _(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = simhash.near_duplicates(docs, shingle=3, distance=2)
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


# --- 8 mixing ------------------------------------------------------------------

SEED = 17


def square_root_targets(docs):
    """Target weight of a source: the whole root of its characters, which evens sources out."""
    return docs.groupBy("source").agg(
        F.floor(F.sqrt(F.sum("n_chars").cast("double"))).cast("double").alias("weight"))


def unit_sql(*parts):
    text = " || ':' || ".join(parts)
    return f"(CAST(CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0"


@query("op8_mix_sources", f"""
WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(greatest(coalesce(n_chars, 0), 0)) AS BIGINT) AS size,
         floor(sqrt(CAST(sum(n_chars) AS DOUBLE))) AS weight
  FROM documents GROUP BY source),
present AS (SELECT * FROM sizes WHERE weight > 0 AND size > 0),
rates AS (
  SELECT source, weight / (SELECT sum(weight) FROM present)
                 * CAST((SELECT sum(size) FROM present) AS DOUBLE) / size AS rate
  FROM present),
cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS cdf FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), cdf + p * rate / (k + 1) FROM cdf
  WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
units AS (
  SELECT doc_id, source, {unit_sql(f"'{SEED}'", "'1'", "CAST(doc_id AS VARCHAR)")} AS u FROM documents),
counts AS (
  SELECT doc_id, u.source, count(*) FILTER (WHERE cdf <= u) AS n
  FROM units u JOIN cdf c ON u.source IS NOT DISTINCT FROM c.source GROUP BY doc_id, u.source),
copies AS (
  SELECT doc_id, source, CAST(unnest(range(1, n + 1)) AS INTEGER) AS "copy" FROM counts)
SELECT doc_id, source, "copy",
       {unit_sql(f"'{SEED}/order'", "CAST(doc_id AS VARCHAR)", 'CAST("copy" AS VARCHAR)')} AS order_key
FROM copies""")
def _(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "n_chars")
    mixed = mixing.mix(docs, square_root_targets(docs), "n_chars", seed=SEED)
    return mixed.select("doc_id", "source", "copy", "order_key")


# --- 9 URL filter --------------------------------------------------------------

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
URL_RULES_SQL = ", ".join(str(rule) for rule in URL_RULES)


@query("op9_url_filter", rf"""
WITH split AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
hosts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split),
rules(rule_host, rule_path, verdict) AS (VALUES {URL_RULES_SQL}),
fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, verdict
  FROM hosts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
best AS (
  SELECT page_id, rule, verdict FROM fits
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1)
SELECT h.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM hosts h LEFT JOIN best b ON h.page_id = b.page_id""")
def _(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(read(spark, sf_dir, "pages", "page_id", "url"), rules)


# --- 7 secrets -----------------------------------------------------------------


def secret_model(spark, docs):
    samples = secrets.random_strings(spark).unionByName(secrets.ordinary_identifiers(docs))
    return secrets.train(samples)


@query("op7_secret_scan")
def _(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return secrets.report(docs, secret_model(spark, docs))


# --- 5 substrings --------------------------------------------------------------

WINDOW_SQL = " || ' ' || ".join(f"lead(w, {n}) OVER d" for n in range(substrings.WINDOW))


@query("op5_substring_dedup", f"""
WITH tokens AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents)),
windows AS (
  SELECT doc_id, i, {WINDOW_SQL} AS seq FROM tokens WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
firsts AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY seq) AS first FROM windows WHERE seq IS NOT NULL),
covered AS (
  SELECT DISTINCT doc_id, i + k AS i FROM firsts, range({substrings.WINDOW}) AS s(k) WHERE first < doc_id),
marked AS (
  SELECT t.doc_id, t.i, w, c.i IS NOT NULL AS gone
  FROM tokens t LEFT JOIN covered c ON t.doc_id = c.doc_id AND t.i = c.i),
counted AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(w, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN counted c ON d.doc_id = c.doc_id""")
def _(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return substrings.repeated_spans(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


# --- 3 packing -----------------------------------------------------------------


def packed(docs):
    """Pieces with the checksum of their ids in place of the ids."""
    return packing.pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op3_hilbert_packing")
def _(spark, sf_dir):
    return packed(read(spark, sf_dir, "documents", "doc_id", "text"))


# --- 2 HTML extraction ---------------------------------------------------------


@query("op2_html_extract")
def _(spark, sf_dir):
    return extract.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


# --- 6 toxicity ----------------------------------------------------------------


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


@query("op6_toxicity")
def _(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out())
    lexicon = toxicity.train(docs, labels)
    scored = toxicity.score(docs, lexicon)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


# --- 10 vectors ----------------------------------------------------------------


@query("op10_embedding_near_dedup", f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
units AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM vectors),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b
    ON a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {caps.THRESHOLD}),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM units
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
smallest AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings e LEFT JOIN smallest s ON e.vec_id = s.a LEFT JOIN degrees d ON e.vec_id = d.a""")
def _(spark, sf_dir):
    return caps.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))

# --- 12 filter interactions -----------------------------------------------------

FILTER_BITS = "\n".join(
    f"+ CASE WHEN instr(letters, '{name}') > 0 THEN {1 << bit} ELSE 0 END" for bit, name in enumerate(audit.FILTERS))


@query("op12_filter_audit", f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS words
  FROM documents),
failing AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < {audit.LEAST_WORDS} THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < {audit.LEAST_DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g'))
                     > {audit.MOST_UPPER_PERCENT} * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM texts),
marked AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good,
         count(*) FILTER (WHERE toxic = 1) AS toxic
  FROM failing f LEFT JOIN labels l ON f.doc_id = l.doc_id GROUP BY part, mask),
letters AS (SELECT unnest(string_split('{' '.join(audit.FILTERS)}', ' ')) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, CAST(step AS BIGINT), 1) AS letters,
         substr(filter_order, 1, CAST(step AS BIGINT) - 1) AS earlier
  FROM orders, range(1, 6) AS s(step)),
bits AS (
  SELECT filter_order, step, 0 {FILTER_BITS} AS own,
         0 {FILTER_BITS.replace('letters', 'earlier')} AS earlier
  FROM steps),
counted AS (
  SELECT part, filter_order, step, own,
         CAST(sum(CASE WHEN mask & (own | earlier) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN mask & own > 0 AND mask & earlier > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM marked, bits GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted""")
def _(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    labels = read(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return audit.interactions(audit.postings(docs, labels))


# --- 11 chat formatting ----------------------------------------------------------

PROBE = "</s>[INST] ok [/INST]"
CONTROL_SQL = r"([<\[])(\\*)(" + "|".join(
    re.escape(control[1:]) for control in [*chat.CONTROLS, chat.SPECIAL]) + ")"


def escaped_sql(column):
    return rf"length(regexp_replace({column}, '{CONTROL_SQL}', '\1\\\2\3', 'g'))"


MARKS_SQL = "\n".join(
    f"WHEN '{role}' THEN {len(opening or '') + len(closing)}" for role, (opening, closing) in chat.MARKS.items())


@query("op11_chat_format", f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}'
  UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
sized AS (
  SELECT *, CASE role {MARKS_SQL} ELSE 19 + {escaped_sql('role')} END + {escaped_sql('text')} AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{chat.LEARNED}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = '{chat.LEARNED}'), '')) AS loss_sha256,
       CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""")
def _(spark, sf_dir):
    given = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], given.schema)
    return chat.digests(chat.format_turns(given.unionByName(probe)))


# --- 13 vector codes -------------------------------------------------------------


def codes_sql():
    """The rounds one by one: a table of codebook entries as integer lists after each."""
    floored = f"list_transform(embedding, lambda x: CAST(floor({codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT))"
    distance = "list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - e[i]) * (v[i] - e[i])))"
    tables = [f"""
whole AS MATERIALIZED (
  SELECT vec_id, label, {floored} AS ints FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, p, ints[p * len(ints) // {codes.PARTS} + 1 : (p + 1) * len(ints) // {codes.PARTS}] AS v
  FROM whole, range({codes.PARTS}) AS r(p)),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS entry, v AS e
  FROM parts QUALIFY entry < {codes.ENTRIES})"""]
    for turn in range(codes.ROUNDS + 1):
        tables.append(f"""
near{turn} AS MATERIALIZED (
  SELECT vec_id, label, p, v, entry, {distance} AS d FROM parts JOIN book{turn} USING (p)
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, entry) = 1)""")
        if turn < codes.ROUNDS:
            tables.append(f"""
means{turn} AS (
  SELECT p, entry, list(m ORDER BY i) AS e FROM (
    SELECT p, entry, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS m
    FROM near{turn}, range(1, 100000) AS s(i) WHERE i <= len(v) GROUP BY p, entry, i) GROUP BY p, entry),
book{turn + 1} AS MATERIALIZED (
  SELECT p, entry, coalesce(m.e, b.e) AS e FROM book{turn} b LEFT JOIN means{turn} m USING (p, entry))""")
    last = codes.ROUNDS
    return "WITH " + ",".join(tables) + f""",
coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', entry), '' ORDER BY p) AS code,
         CAST(sum(d) AS BIGINT) AS error FROM near{last} GROUP BY vec_id),
books AS (
  SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM book{last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, books"""


@query("op13_vector_codes", codes_sql())
def _(spark, sf_dir):
    return codes.compress(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
