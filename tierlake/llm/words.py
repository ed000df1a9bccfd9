"""Words of a text: runs of anything but the space and the five ASCII controls 0x09-0x0D."""

import hashlib
import re

SPACES = " \t\n\x0b\x0c\r"
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")
SEGMENT = 1 << 20


def utf8(text):
    """UTF-8 of a text; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass")


def segments(raw, size=SEGMENT):
    """Parts of about ``size`` bytes of a UTF-8 text, cut at white space: few objects at a time."""
    at = 0
    while len(raw) - at > size:
        space = _SPACE.search(raw, at + size)
        if space is None:
            break
        yield raw[at:space.start()]
        at = space.start()
    yield raw[at:] if at else raw


def words(text):
    """The words as UTF-8 bytes; ``bytes.split`` knows exactly these six separators."""
    return utf8(text).split()


def words_and_sha(raw):
    """Number of words, and SHA-256 of the words joined by one space."""
    count, digest = 0, hashlib.sha256()
    for part in segments(raw):
        own = part.split()
        if own:
            digest.update((b" " if count else b"") + b" ".join(own))
            count += len(own)
    return count, digest.hexdigest()
