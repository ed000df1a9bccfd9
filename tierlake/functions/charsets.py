"""Text of JSON files in any character set that JSON may be stored in."""

from functools import reduce

from pyspark.sql import functions as F

from tierlake.session import setting

# Byte order marks, longest first: the mark of UTF-16LE begins that of UTF-32LE.
MARKS = [
    ("UTF-32BE", "0000FEFF"), ("UTF-32LE", "FFFE0000"), ("UTF-8", "EFBBBF"), ("UTF-16BE", "FEFF"), ("UTF-16LE", "FFFE"),
]
# JSON begins with ASCII characters, so zero bytes among the first four tell the rest.
ZEROS = [("UTF-32BE", "^000000"), ("UTF-32LE", "^..000000"), ("UTF-16BE", "^00"), ("UTF-16LE", "^..00")]


def charset(content):
    """Name of the character set of a binary column, by its mark or its zero bytes."""
    start = F.hex(F.substring(content, 1, 4))
    found = [(name, start.startswith(mark)) for name, mark in MARKS]
    found += [(name, start.rlike(zeros)) for name, zeros in ZEROS]
    return reduce(lambda rest, case: F.when(case[1], case[0]).otherwise(rest), reversed(found), F.lit("UTF-8"))


def with_text(df, content="content", text="payload", sound="sound"):
    """``df`` with the decoded ``text`` of a binary column, and whether it is ``sound``.

    A byte order mark is no part of the text. Where bytes are no text in the column's
    character set, ``text`` has U+FFFD in their place and ``sound`` is false.
    """
    name = charset(content)
    marked = F.hex(F.substring(content, 1, 4))
    skip = reduce(
        lambda rest, case: F.when(marked.startswith(case[1]), len(case[1]) // 2).otherwise(rest),
        reversed(MARKS), F.lit(0))
    body = F.substring(F.col(content), skip + 1, F.length(content))
    names = sorted({case[0] for case in MARKS} - {"UTF-8"})
    with setting(df.sparkSession, "spark.sql.legacy.javaCharsets", "true"), \
            setting(df.sparkSession, "spark.sql.legacy.codingErrorAction", "true"):
        # Both options are part of the expressions once these are resolved.
        parts = df.withColumns({"_charset": name, "_body": body})
        raw = F.col("_body").cast("string")
        decoded, same = F.make_valid_utf8(raw), F.is_valid_utf8(raw)
        for other in names:
            here, there = F.col("_charset") == other, F.decode("_body", other)
            decoded = F.when(here, there).otherwise(decoded)
            same = F.when(here, F.encode(there, other) == F.col("_body")).otherwise(same)
        return parts.withColumns({text: decoded, sound: same}).drop("_charset", "_body")
