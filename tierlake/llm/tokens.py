"""Token ids of the public vocabularies."""

import base64
from functools import lru_cache

TOKENIZER = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def _ranks(name):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def encoder(name=TOKENIZER):
    """Function from a text to its ids, without added special tokens.

    The ids are those of the ``tokenizers`` file. The same vocabulary and merges, as ranks, are
    read by a library that is several times faster. Texts with the special token's own
    string go through ``tokenizers``, and so do those that the fast library gives up on: it
    panics at white space of about a million characters in a row.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    fast = _ranks(name)
    exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))

    def encode(text):
        if SPECIAL not in text:
            try:
                return fast.encode_ordinary(text)
            except BaseException as error:  # a panic is no Exception
                if type(error).__name__ != "PanicException":
                    raise
        return exact.encode(text, add_special_tokens=False).ids

    return encode


def decoder(name=TOKENIZER):
    """Function from ids of ordinary text back to the text."""
    fast = _ranks(name)
    return lambda ids: fast.decode_bytes(ids).decode("utf-8", "replace")


def vocabulary_size(name=TOKENIZER):
    """Number of ids in use; larger ones are free."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(f"{name}.json")).get_vocab_size()
