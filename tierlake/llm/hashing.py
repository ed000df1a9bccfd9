"""Hashes of words and of windows of words, for whole blocks of texts at once."""

import hashlib

import numpy as np

from tierlake.llm.words import segments

_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEPS = [np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)]
_SEEDS = [np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)]
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
BLOCK_BYTES = 1 << 20
LONG_WORD = 256  # longer words, in bytes, are hashed one by one


def blocks(texts):
    """``(first, texts)`` of neighbouring texts, of about ``BLOCK_BYTES`` together or one long text."""
    first, size = 0, 0
    for at, text in enumerate(texts):
        if at > first and size + len(text) > BLOCK_BYTES:
            yield first, texts[first:at]
            first, size = at, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def word_hashes(texts):
    """``(hashes, owner)`` of all words of some UTF-8 texts; ``owner`` is the text's number.

    ``hashes`` has two 64-bit numbers for each word, made with different seeds. Eight bytes at a
    time are mixed in with a finalizer, so no pattern of letters makes different words agree,
    and words of up to eight bytes and the same length never do.
    """
    parts, owners, held, size = [], [], [], 0

    def flush():
        nonlocal held, size
        if held:
            hashes, piece = _hashes([part for part, _ in held])
            parts.append(hashes)
            owners.append(np.array([owner for _, owner in held])[piece])
        held, size = [], 0

    for owner, text in enumerate(texts):
        for part in segments(text):
            held.append((part, owner))
            size += len(part)
            if size > BLOCK_BYTES:
                flush()
    flush()
    if not parts:
        return np.zeros((0, 2), np.uint64), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(owners)


def _hashes(pieces):
    """Hashes of the words of some byte strings, and the number of the piece each lies in."""
    joined = b" ".join([b"", *pieces, bytes(8)])
    raw = np.frombuffer(joined, np.uint8)[:-8]
    space = _IS_SPACE[raw]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    stops = np.flatnonzero(~space[:-1] & space[1:]) + 1
    lengths = stops - starts
    # The eight bytes from every position on, as one number each.
    eight = np.ndarray(len(joined) - 7, "<u8", joined, strides=(1,))
    states = [_mixed(lengths.astype(np.uint64) + seed) for seed in _SEEDS]
    words = np.flatnonzero(lengths <= LONG_WORD)
    at, left = starts[words], lengths[words]
    while len(words):
        lane = eight[at] & _LOW_BYTES[np.minimum(left, 8)]
        for state, step in zip(states, _STEPS):
            state[words] = _mixed((state[words] ^ lane) * step)
        more = left > 8
        words, at, left = words[more], at[more] + 8, left[more] - 8
    hashes = np.stack(states, axis=1)
    for word in np.flatnonzero(lengths > LONG_WORD).tolist():
        digest = hashlib.blake2b(joined[starts[word]:stops[word]], digest_size=16).digest()
        hashes[word] = np.frombuffer(digest, "<u8")
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    return hashes, np.searchsorted(np.cumsum(sizes + 1) - sizes, starts, "right") - 1


def window_hashes(hashes, size):
    """Hash of every window of ``size`` words, also of those that cross from text to text.

    Windows are joined from windows of 1, 2, 4, ... words, with a finalizer after each join, so
    no pattern of words makes different windows agree.
    """
    count = len(hashes) - size + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    power, length, whole, have = hashes, 1, None, 0
    while True:
        if size & length:
            part = power[have:have + count]
            whole = part if whole is None else _joined(whole, part)
            have += length
        if 2 * length > size:
            return whole
        power = _joined(power[:-length], power[length:])
        length *= 2


def _joined(first, second):
    return _mixed(first * _STEP + second)


def _mixed(x):
    """Finalizer that spreads every bit over the whole number."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
