"""Token ids of a whole corpus by a public byte-level BPE vocabulary.

Two neighbouring bytes that never stand side by side inside any vocabulary token can't be merged, so a
token boundary between them is certain whatever the rest of the text is. The text is cut at such places,
each distinct fragment is encoded once per task, and the ids are put together again.

The tokenizer first splits a text with a pattern that looks ahead at white space and at contractions, so
a cut must also leave that split alone. It does if it stands between two characters, the one before is not
white space, and the one after is not an apostrophe: the pattern has no look-behind, so it goes on after
the cut as it would have, and a run of letters, digits or marks cut in two stays two runs of its kind,
between whose bytes no merge was possible anyway.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
#: Fragments kept by a task; beyond, the store starts anew, which costs time but changes nothing.
STORE_LIMIT = 400_000

_loaded: dict = {}


class Encoder:
    def __init__(self, folder: str, name: str):
        import sys

        import tiktoken

        if folder not in sys.path:
            sys.path.append(os.path.dirname(os.path.realpath(folder)))
        import public_tokenizers

        with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        inside = np.zeros(65536, bool)
        for token in ranks:
            for a, b in zip(token, token[1:]):
                inside[a * 256 + b] = True
        nxt = np.arange(65536) & 255
        #: True where a cut between the two bytes is certain: no merge, between characters, not before an apostrophe.
        self.cut = ~inside & ((nxt & 0xC0) != 0x80) & (nxt != 0x27)
        self.store: dict[bytes, np.ndarray] = {}
        self.sizes: dict[bytes, int] = {}

    def fragments(self, data: bytes) -> list[bytes]:
        b = np.frombuffer(data, np.uint8)
        if len(b) < 2:
            return [data]
        at = np.flatnonzero(self.cut[b[:-1].astype(np.int32) * 256 + b[1:]]) + 1
        ends = [0, *(i for i in at.tolist() if not _ends_in_space(data, i)), len(data)]
        return [data[i:j] for i, j in zip(ends, ends[1:])]

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if len(self.store) > STORE_LIMIT:
            self.store.clear()
        out, store = [], self.store
        for x in self.fragments(text.encode("utf-8", "replace")):
            if (found := store.get(x)) is None:
                found = store[x] = np.array(self.encoding.encode_ordinary(x.decode("utf-8")), np.int32)
            out.append(found)
        return np.concatenate(out)


    def count(self, text: str | None) -> int:
        """How many ids ``ids`` gives, without putting them together."""
        if not text:
            return 0
        if len(self.sizes) > STORE_LIMIT:
            self.sizes.clear()
        n, sizes = 0, self.sizes
        for x in self.fragments(text.encode("utf-8", "replace")):
            if (found := sizes.get(x)) is None:
                found = sizes[x] = len(self.encoding.encode_ordinary(x.decode("utf-8")))
            n += found
        return n


def _ends_in_space(data: bytes, i: int) -> bool:
    """Whether the character before byte i is white space."""
    last = data[i - 1]
    if last < 0x80:
        return last in b"\t\n\v\f\r \x1c\x1d\x1e\x1f"
    j = i - 1
    while data[j] & 0xC0 == 0x80:
        j -= 1
    return data[j:i].decode("utf-8").isspace()


def encoder(folder: str, name: str) -> Encoder:
    """One encoder per worker process."""
    if (folder, name) not in _loaded:
        _loaded[folder, name] = Encoder(folder, name)
    return _loaded[folder, name]


def encode(df: DataFrame, text: str = "text", out: str = "ids", name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """Add ``out``: the ids of the whole text, without special tokens, whose strings count as ordinary text.

    A null and an empty text both give an empty list. Other columns, nulls among them, pass through; an
    older column called ``out`` is replaced.
    """

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(folder, name)
        for s in batches:
            yield pd.Series([e.ids(t) for t in s], dtype=object)

    return df.withColumn(out, ids(F.col(text)))


def count_tokens(df: DataFrame, text: str = "text", out: str = "n_tokens", name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """Add ``out``: how many ids ``encode`` would give."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(folder, name)
        for s in batches:
            yield pd.Series([e.count(t) for t in s], dtype="int64")

    return df.withColumn(out, count(F.col(text)))
