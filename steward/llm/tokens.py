"""Token ids of texts by a public byte-level BPE vocabulary, as tasks use it."""

from __future__ import annotations

import base64
import functools
import os


def vocabulary_path(name: str) -> str:
    """Where a file of the installed public vocabularies lies; every executor has them."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _ranked(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def byte_lengths(ranks_path: str):
    """How many bytes each id of the vocabulary stands for; encoding loses none, so sums of them are offsets."""
    import numpy as np

    ranked = _ranked(ranks_path)
    return np.array([len(ranked.decode_single_token_bytes(i)) for i in range(ranked.n_vocab)], dtype=np.int64)


def decode(ids: list[int], ranks_path: str) -> bytes:
    """The bytes of ``ids``; they need not be whole characters."""
    return _ranked(ranks_path).decode_bytes(ids)


@functools.cache
def _loaded(path: str, names_are_text: bool):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = names_are_text
    return tokenizer


@functools.cache
def _names(path: str) -> tuple[str, ...]:
    """How the tokens look in a text that the vocabulary has beside its pieces, such as the one for a text's end."""
    return tuple(t.content for t in _loaded(path, False).get_added_tokens_decoder().values())


def encode(text: str, json_path: str, ranks_path: str | None, names_are_text: bool = True) -> list[int]:
    """The ids of ``text`` in the vocabulary of ``json_path``, special tokens' names being ordinary text; or, if
    ``names_are_text`` is false, the tokens of these names, as the file has it.

    ``ranks_path`` names the same vocabulary as merge ranks, which encode several times faster; the tests hold both ways
    against each other. Texts that the faster one gives up on (runs of white space too long for its pattern) take the other.
    """
    named = not names_are_text and any(name in text for name in _names(json_path))
    if ranks_path and not named:
        try:
            return _ranked(ranks_path).encode_ordinary(text)
        except BaseException as error:  # its panics are no Exceptions
            if isinstance(error, (KeyboardInterrupt, SystemExit, GeneratorExit)):
                raise
    return _loaded(json_path, not named).encode(text, add_special_tokens=False).ids
