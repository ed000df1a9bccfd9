"""Secrets in texts: fixed patterns, and random strings told by two character Markov models.

DataFrame functions only. Positions are code points, ends are exclusive.
"""

import math

from pyspark.sql import functions as F

from tierlake.llm.common import hash_sample, restored, shielded, without

KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
# A maximal run that is too short holds no match that is long enough, so the least length can
# stand in these two patterns. In ASSIGN it cannot: a failing match uses up its characters.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE_LEAST = 16
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
SEPARATORS = "+/_-"
ORDINARY_RUN = (r"(?<![A-Za-z0-9+/_=-])(?:\+?[0-9]+(?:[+/_-][0-9]+)+|[0-9]{4,}|[A-Z]{2,}(?:[+/_-][A-Z]{2,})+)"
                r"(?![A-Za-z0-9+/_=-])")
#: Orders in which people type or list characters; runs of them are no random strings.
SEQUENCES = ["abcdefghijklmnopqrstuvwxyz", "0123456789", "qwertyuiop", "qwertzuiop", "asdfghjkl", "zxcvbnm", "yxcvbnm",
             "qwertyuiopasdfghjklzxcvbnm", "qwertzuiopasdfghjklyxcvbnm", "azertyuiopqsdfghjklmwxcvbn"]
THRESHOLD = 30.0  # least log-likelihood ratio of a span ...
RATE = 2.0  # ... and least ratio for each of its characters
STATES = len(ALPHABET) + 1  # 0 stands for any other character
CHUNK = 256
TEXT_CHUNK = 4096
SAMPLE_TASKS = 48


# --- the Markov models ---------------------------------------------------------


def random_strings(spark, rows=3000):
    """Labelled samples ``(text, secret)`` of random strings: SHA-256 digests as hex and base64."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    base64 = F.base64(F.unhex(digest))
    size = (20 + F.col("id") % 24).cast("int")
    return spark.range(rows).select(
        F.explode(F.array(F.substring(digest, F.lit(1), size), F.substring(base64, F.lit(1), size),
                          F.translate(F.substring(base64, F.lit(1), size), "+/=", ""))).alias("text"),
        F.lit(1).alias("secret"))


def ordinary_identifiers(docs, text_column="text", rows=2000):
    """Labelled samples of what is no secret: names put together from neighbouring words, and numbers.

    They come from about ``rows`` documents, those with the smallest hash of their text, copies
    counted once; of these, every word of letters counts, and every run of numbers or of words
    in upper case. As texts may hold few of them, dates and numbers in groups are made by rule
    beside the names, and the alphabet, rows of keys and the like (``SEQUENCES``), both ways.
    """
    texts = docs.select(F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("t"))
    # The sample is small in bytes, and would else be put together in a few tasks.
    some = hash_sample(texts, "t", rows).dropDuplicates(["t"]).repartition(SAMPLE_TASKS)
    words = some.select(F.regexp_extract_all("t", F.lit(r"[A-Za-z]{2,}"), 0).alias("w"))
    three = F.slice("w", F.col("i"), 3)
    named = words.where("size(w) >= 3").select(
        "w", F.explode(F.sequence(F.lit(1), F.size("w") - 2, F.lit(3))).alias("i")).select(
        F.explode(F.array(
            F.array_join(three, "_"), F.array_join(three, "-"), F.array_join(three, "/"),
            F.array_join(F.transform(three, F.initcap), ""), F.array_join(three, ""),
            F.concat(F.array_join(three, "_"), F.lit("_"), (F.col("i") % 100).cast("string")),
            F.upper(F.array_join(three, "_")), F.upper(F.array_join(three, "-")), _numbers(three),
        )).alias("text"))
    runs = some.select(F.explode(F.regexp_extract_all("t", F.lit(ORDINARY_RUN), 0)).alias("text"))
    rows = [s for sequence in SEQUENCES for s in (sequence, sequence[::-1], sequence.upper(), sequence[::-1].upper())]
    sequences = docs.sparkSession.range(300).select(F.explode(F.split(F.lit(" ".join(rows)), " ")).alias("text"))
    named = named.unionByName(runs).unionByName(sequences)
    return named.withColumn("secret", F.lit(0))


def _numbers(three):
    """Column: a date, a time or a number in groups, drawn by the hash of some words."""
    draw = F.xxhash64(three)
    digits = F.lpad(F.pmod(draw, F.lit(10**16)).cast("string"), 16, "0")
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.pmod(draw, F.lit(25000)).cast("int"))
    day = F.date_format(date, "yyyy-MM-dd")
    time = F.concat(F.lpad(F.pmod(draw, F.lit(24)).cast("string"), 2, "0"), F.lit("-"),
                    F.lpad(F.pmod(draw, F.lit(60)).cast("string"), 2, "0"), F.lit("-"), F.substring(digits, 1, 2))

    def groups(sign, *sizes):
        ends = [sum(sizes[:n]) for n in range(len(sizes))]
        return F.concat_ws(sign, *[F.substring(digits, at + 1, size) for at, size in zip(ends, sizes)])

    made = F.array(
        day, F.concat(day, F.lit("/"), day), F.concat(day, F.lit("T"), time), F.date_format(date, "yyyy/MM/dd"),
        F.date_format(date, "yyyy_MM_dd"), F.concat(F.lit("+"), groups("-", 1, 3, 3, 4, 4)),
        groups("-", 3, 1, 2, 6, 1), groups("/", 3, 4, 3), groups("_", 4, 4, 4), digits)
    return F.get(made, F.pmod(F.shiftright(draw, 20), F.lit(10)).cast("int"))


def train(samples, smoothing=0.5):
    """Log-likelihood ratio of each pair of characters, as ``STATES`` x ``STATES`` numbers.

    ``samples`` has ``text, secret`` (1 random string, 0 ordinary; nulls are ignored). Pairs
    are counted in tasks; at most two numbers for each pair of the fixed alphabet reach
    the driver. Separators in a row, as in drawn lines, never speak for a random string.
    """
    index = _indices(F.col("text"))
    pairs = samples.where("text IS NOT NULL AND secret IS NOT NULL").select(
        "secret", index.alias("c")).where("size(c) > 1").select(
        "secret", F.explode(F.transform(
            F.sequence(F.lit(1), F.size("c") - 1),
            lambda i: F.get("c", i - 1) * STATES + F.get("c", i))).alias("pair"))
    counts = pairs.groupBy("secret", "pair").agg(F.count("*").alias("n")).collect()
    seen = {label: [smoothing] * STATES ** 2 for label in (0, 1)}
    for row in counts:
        if row["secret"] in seen:
            seen[row["secret"]][row["pair"]] += row["n"]
    logs = {}
    for label, table in seen.items():
        sums = [sum(table[a * STATES:(a + 1) * STATES]) for a in range(STATES)]
        logs[label] = [math.log(n / sums[pair // STATES]) for pair, n in enumerate(table)]
    ratios = [random - ordinary for random, ordinary in zip(logs[1], logs[0])]
    signs = [ALPHABET.index(c) + 1 for c in SEPARATORS + "="]
    for pair in (a * STATES + b for a in signs for b in signs):
        ratios[pair] = min(ratios[pair], 0.0)
    return ratios


def _index(char):
    return F.call_function("locate", char, F.lit(ALPHABET))


def _indices(text):
    return F.transform(F.split(text, ""), _index)


def log_likelihood_ratio(text, model):
    """Column: sum of the model's ratios over the pairs of neighbouring characters of ``text``."""
    # One string literal, which Spark folds to one constant array.
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        _indices(text), start,
        lambda s, c: F.struct(
            c.alias("last"),
            (s["sum"] + F.when(s["last"] >= 0, F.get(table, s["last"] * STATES + c)).otherwise(0.0))
            .alias("sum")),
        lambda s: s["sum"])


def random_parts(text, model, threshold, rate):
    """Column: array of ``(start, end)`` of the parts of ``text`` that the model takes for random.

    The whole text if its ratio reaches ``threshold``, and ``rate`` for each character; else
    every part of largest sum that does, widened to the separators around it, if it is then as
    long as a candidate has to be. A part ends where the sum falls to 0, or by ``threshold``
    below its largest value.
    """
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    kind = "array<struct<start:int,end:int>>"
    start = F.struct(
        F.lit(-1).alias("last"), F.lit(0).alias("at"), F.lit(0.0).alias("total"), F.lit(0.0).alias("sum"),
        F.lit(0).alias("start"), F.lit(0.0).alias("best"), F.lit(0).alias("end"),
        F.array().cast(kind).alias("parts"))

    def closed(s):
        part = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        random = (s["best"] >= threshold) & (s["best"] >= rate * (s["end"] - s["start"]))
        return F.when(random, F.concat(s["parts"], F.array(part))).otherwise(s["parts"])

    def step(s, c):
        ratio = F.when(s["last"] >= 0, F.get(table, s["last"] * STATES + c)).otherwise(0.0)
        # An array of one element gives the sums a name, so that they are computed once.
        made = F.transform(F.array(F.struct(ratio.alias("ratio"), (s["sum"] + ratio).alias("sum"))), lambda r: F.struct(
            c.alias("last"), (s["at"] + 1).alias("at"), (s["total"] + r["ratio"]).alias("total"),
            F.when((r["sum"] <= 0) | (r["sum"] <= s["best"] - threshold), 0.0).otherwise(r["sum"]).alias("sum"),
            F.when((r["sum"] <= 0) | (r["sum"] <= s["best"] - threshold), s["at"]).otherwise(s["start"]).alias("start"),
            F.when((r["sum"] <= 0) | (r["sum"] <= s["best"] - threshold), 0.0)
            .otherwise(F.greatest(s["best"], r["sum"])).alias("best"),
            F.when(r["sum"] > s["best"], s["at"] + 1).otherwise(s["end"]).alias("end"),
            F.when((r["sum"] <= 0) | (r["sum"] <= s["best"] - threshold), closed(s))
            .otherwise(s["parts"]).alias("parts")))
        return F.get(made, 0)

    whole = F.array(F.struct(F.lit(0).alias("start"), F.length(text).alias("end")))

    def widened(part):
        plain = F.translate(text, SEPARATORS + "=", "-" * (len(SEPARATORS) + 1))
        left = F.substring_index(F.substring(plain, F.lit(1), part["start"]), "-", -1)
        right = F.substring_index(F.substring(plain, part["end"] + 1, F.length(text)), "-", 1)
        return F.struct((part["start"] - F.length(left)).alias("start"), (part["end"] + F.length(right)).alias("end"))

    def finish(s):
        wide = F.array_distinct(F.transform(closed(s), widened))
        random = (s["total"] >= threshold) & (s["total"] >= rate * F.length(text))
        return F.when(random, whole).otherwise(
            F.filter(wide, lambda p: p["end"] - p["start"] >= CANDIDATE_LEAST))

    return F.aggregate(_indices(text), start, step, finish)


# --- spans ---------------------------------------------------------------------


def _matches(df, name, pattern, value_group=0, column="_text"):
    """Add ``{name}``: array of ``(start, end, value)`` of all matches in ``column``, left to right.

    Lengths of the matches and of the gaps between them give the positions. They are summed
    over chunks, so a text with very many matches takes no quadratic time.
    """
    found, gaps, lens, sums = (f"_{name}_{x}" for x in ("found", "gaps", "lens", "sums"))
    df = df.withColumn(found, F.regexp_extract_all(column, F.lit(pattern), 0))
    some = F.size(found) > 0
    df = df.withColumn(gaps, F.when(some, F.split(column, pattern, -1)))
    if value_group:
        df = df.withColumn(f"{found}v", F.when(some, F.regexp_extract_all(column, F.lit(pattern), value_group)))
    df = df.withColumn(lens, F.zip_with(found, gaps, lambda m, g: F.length(m) + F.length(g)))

    def total(array):
        return F.aggregate(array, F.lit(0), lambda a, b: a + b)

    chunks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / CHUNK).cast("int"))
    df = df.withColumn(sums, F.when(some, F.transform(
        chunks, lambda c: total(F.slice(lens, c * CHUNK + 1, F.lit(CHUNK))))))

    def span(match, i):
        chunk = F.floor(i / CHUNK).cast("int")
        before = total(F.slice(sums, F.lit(1), chunk)) + total(
            F.slice(lens, chunk * CHUNK + 1, i - chunk * CHUNK))
        start = before + F.length(F.get(gaps, i))
        value = F.get(f"{found}v", i) if value_group else match
        return F.struct(start.alias("start"), (start + F.length(match)).alias("end"), value.alias("value"))

    kind = "array<struct<start:int,end:int,value:string>>"
    spans = F.when(some, F.transform(found, span)).otherwise(F.array().cast(kind))
    return df.withColumn(name, spans).drop(found, gaps, lens, sums, f"{found}v")


def replaced(text, spans, mark):
    """Column: ``text`` with every span, or run of overlapping spans, replaced.

    ``spans`` are sorted by their start. ``mark`` makes what stands in their place, from the
    number of characters that are gone and whether a run of spans begins here. The text is cut into chunks once, and each piece between
    the spans is put together from those it lies in: a position in a long text would otherwise
    be counted from its beginning for each span.
    """
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_CHUNK}}}"), 0)

    def most(array):
        return F.coalesce(F.array_max(array), F.lit(0))

    def piece(given, start, end):
        low, high = F.floor(start / TEXT_CHUNK).cast("int"), F.floor((end - 1) / TEXT_CHUNK).cast("int")
        some = F.array_join(F.slice(given["chunks"], low + 1, high - low + 1), "")
        return F.when(end <= start, "").otherwise(F.substring(some, start - low * TEXT_CHUNK + 1, end - start))

    def joined(given):
        spans, ends = given["spans"], given["ends"]
        steps = F.sequence(F.lit(0), F.floor((F.size(ends) - 1) / CHUNK).cast("int"))
        tops = F.transform(steps, lambda c: most(F.slice(ends, c * CHUNK + 1, F.lit(CHUNK))))
        return F.get(F.transform(F.array(F.struct(
            given["chunks"].alias("chunks"), spans.alias("spans"), ends.alias("ends"), tops.alias("tops"))), pieces), 0)

    def before(given, i):
        """Largest end of the spans before number ``i``."""
        chunk = F.floor(i / CHUNK).cast("int")
        return F.greatest(
            most(F.slice(given["tops"], F.lit(1), chunk)),
            most(F.slice(given["ends"], chunk * CHUNK + 1, i - chunk * CHUNK)))

    def pieces(given):
        def one(span, i):
            # An array of one element gives the position a name, so that it is computed once.
            return F.get(F.transform(F.array(before(given, i)), lambda at: F.concat(
                piece(given, at, span["start"]),
                mark(F.greatest(span["end"] - F.greatest(span["start"], at), F.lit(0)), span["start"] >= at))), 0)

        last = F.array_max(given["ends"])
        return F.concat(F.array_join(F.transform(given["spans"], one), ""), piece(given, last, F.length(text)))

    named = F.array(F.struct(
        chunks.alias("chunks"), spans.alias("spans"), F.transform(spans, lambda s: s["end"]).alias("ends")))
    return F.when(F.size(spans) > 0, F.get(F.transform(named, joined), 0)).otherwise(text)


def _scan(df, model, threshold, rate):
    """Adds ``_base`` and ``secret_spans`` to a frame with the column ``_text``; see :func:`scan`."""
    for name, pattern, group in [("_assign", ASSIGN, 2), ("_access", ACCESS, 0), ("_hex", HEX, 0)]:
        df = _matches(df, name, pattern, group)

    def ranked(array, rank):
        return F.transform(array, lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")))

    assigned = F.filter("_assign", lambda m: F.length(m["value"]) >= ASSIGN_LEAST)
    base = F.concat(ranked(assigned, 0), ranked("_access", 1), ranked("_hex", 2))
    df = df.withColumn("_base", F.sort_array(base)).drop("_assign", "_access", "_hex")
    # What lies outside the base spans, in its place.
    df = df.withColumn("_rest", replaced(F.col("_text"), F.col("_base"), lambda n, _: F.repeat(F.lit("\n"), n)))
    df = _matches(df, "_candidates", CANDIDATE, column="_rest")
    random = F.flatten(F.transform("_candidates", lambda m: F.transform(
        random_parts(m["value"], model, threshold, rate), lambda p: F.struct(
            (m["start"] + p["start"]).alias("start"), (m["start"] + p["end"]).alias("end")))))
    df = df.withColumn("_markov", ranked(random, 3))
    spans = F.when(F.size("_markov") > 0, F.sort_array(F.concat("_base", "_markov"))).otherwise(F.col("_base"))
    return df.withColumn("secret_spans", spans).drop("_rest", "_candidates", "_markov")


def _with_text(docs, text_column):
    """``docs`` shielded, with the text, null as empty, as ``_text``."""
    given, text = shielded(docs, text_column)
    return given.withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit(""))), text


def scan(docs, model, text_column="text", threshold=THRESHOLD, rate=RATE):
    """``docs`` with ``secret_spans``: array of ``(start, rank, end)``, sorted.

    ``rank`` is the place in ``KINDS``. Beside the patterns, a run of characters as keys are
    made of, outside the spans of the patterns, is a span of kind ``markov`` if the
    log-likelihood ratio of the random model against the ordinary one is at least
    ``threshold``, and ``rate`` for each character, or else the parts of the run for which it is (:func:`random_parts`).
    Null is an empty text. Everything happens within the row: nothing is shuffled. A
    column ``secret_spans`` gives way, other columns stay.
    """
    docs = without(docs, "secret_spans")
    found, _ = _with_text(docs, text_column)
    found = _scan(found, model, threshold, rate)
    names = [f"c{i}" for i in range(len(docs.columns))]
    return found.select(*names, "secret_spans").toDF(*docs.columns, "secret_spans")


def listed(spans):
    """``kind:start:end`` of a span array, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs, model, id_column="doc_id", text_column="text", threshold=THRESHOLD, rate=RATE):
    """``(id, n_assign, n_access, n_hex, base_sha256, spans)`` per row; other columns are ignored."""
    given = docs.select(
        F.col(id_column).alias("_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("_text"))
    found = _scan(given, model, threshold, rate)

    def number(rank):
        return F.size(F.filter("_base", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        F.col("_id").alias(id_column), number(0).alias("n_assign"), number(1).alias("n_access"),
        number(2).alias("n_hex"), F.sha2(listed(F.col("_base")), 256).alias("base_sha256"),
        listed(F.col("secret_spans")).alias("spans"))


def redact(docs, model, text_column="text", mark="[SECRET]", threshold=THRESHOLD, rate=RATE):
    """``docs`` with every span, or run of overlapping spans, replaced by ``mark``.

    Null texts stay null; texts without a span stay as they are, and so do all other columns.
    """
    found, text = _with_text(docs, text_column)
    found = _scan(found, model, threshold, rate)
    clean = replaced(F.col("_text"), F.col("secret_spans"), lambda _, first: F.when(first, mark).otherwise(""))
    changed = F.when(F.size("secret_spans") > 0, clean).otherwise(F.col(text))
    return restored(found.withColumn(text, changed), docs.columns)
