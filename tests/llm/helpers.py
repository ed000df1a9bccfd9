"""Small frames and plain-Python references."""

import re

SF_DIR = "/root/testdata/sf0.001"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")

EDGE_TEXTS = [
    None, "", "   \n\t ", "one", "same words here again and again", "same words here again and again",
    "é ß 漢字 😀 \x0b x y z", "<|endoftext|> in the text", "tab\tand\r\nlines\n\nlines\nlines",
    "long " * 30_000, "x" * 50_000, " " * 1_000_000, "\n" * 1_000_000, "x" * 1_000_000,
]
CLASHING = "n_words long, fp long, copy int, rate double, kept boolean, uid long, part int, key long, lang string"


def edge_docs(spark, texts=EDGE_TEXTS):
    """Odd texts with a null id, repeated rows and columns named like the operators' own."""
    rows = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, "a row without an id", None, None, None), rows[4], (4, "another text with id four", "en", "src", 3)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ", ".join(c for c in CLASHING.split(", ") if not c.startswith("lang"))
    full = [(*row, 1, 2, 3, 0.5, True, 4, 5, 6) for row in rows]
    return spark.createDataFrame(full, f"{columns}, {extra}")


def words(text):
    return SPLIT.findall(text or "")


def components(nodes, pairs):
    """Smallest node that each one reaches."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
