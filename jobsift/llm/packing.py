"""Token packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the binary digits of
n (the largest power taken as often as needed). Every piece is a sequence of its
own and equal lengths form a bucket, so no sequence crosses documents and none
needs padding. Nothing is shuffled: each document is cut where it is read.
"""
from __future__ import annotations

import os
import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import bounded_batches

MAX_LENGTH, END_ID = 4096, 2
TOKENIZER = "word_bpe_49k.json"
#: Words of a generation of a Python worker's cache; it holds at most two.
CACHE_WORDS = 600_000
#: Characters that are tokenized together, so that memory stays bounded.
SLICE_CHARS = 2_000_000

# FIXED VALUE: the tokenizer file's split pattern, for lower-cased texts in SIMPLE characters.
PRETOKEN = re.compile(r"[a-zªµºß-öø-ɏ]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼½¾]|[^\t-\r a-zªµºß-öø-ɏ0-9²³¹¼½¾]+")
#: Texts on whose normal form Python and the tokenizer agree: composed Latin letters and no control characters.
NOT_SIMPLE = re.compile(r"[^\t-\r -~¡-įı-ɏ]")


class Encoder:
    """Token ids of texts, as the tokenizer gives them, with a cache of words.

    The tokenizer splits at white space and by a fixed pattern and merges inside
    a piece only, so a text's ids are its pieces' ids in order. Unknown words are
    encoded many at a time: only a word's last token carries the end-of-word mark,
    which tells them apart again. A chunk between white space with other
    characters, or with what may be a special token, goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.is_end = np.zeros(max(vocab.values()) + 1, bool)
        self.is_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _direct(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, new: set[str]) -> None:
        older = [p for p in new if p in self.older]
        self.known.update(zip(older, map(self.older.__getitem__, older)))
        new.difference_update(older)
        words = [p for p in new if p.isalpha()]
        parts = [words[at:at + 64] for at in range(0, len(words), 64)]
        for part, encoded in zip(parts, self.tok.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.asarray(encoded.ids, "<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(part):
                raw, last = ids.tobytes(), 0
                for w, end in zip(part, (ends * 4).tolist()):
                    self.known[w], last = raw[last:end], end
        for p in [p for p in new if p not in self.known]:
            self.known[p] = self._direct(p)

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        cut = [pieces(t) for t in texts]
        new = set().union(*cut) - self.known.keys()
        if new:
            self._learn(new)
        return [b"".join(map(self.known.__getitem__, c)) for c in cut]


def is_simple(text: str) -> bool:
    return "<|" not in text and not NOT_SIMPLE.search(text)


def pieces(text: str) -> list[str]:
    """Pieces that are tokenized by themselves."""
    if is_simple(text):
        return PRETOKEN.findall(text.lower())
    out = []
    for chunk in ASCII_WHITE.split(text):
        out += PRETOKEN.findall(chunk.lower()) if is_simple(chunk) else [chunk]
    return out


ASCII_WHITE = re.compile(r"[\t-\r ]+")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # a Spark task has one core
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Powers of two, at most ``longest`` (a power of two), largest first, that sum to n."""
    out = [longest] * (n // longest)
    return out + [1 << k for k in range(longest.bit_length() - 2, -1, -1) if n % longest >> k & 1]


def slices(texts: list[str]):
    """(first, last) row ranges of at most SLICE_CHARS characters, or one row."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE_CHARS:
            yield first, i
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, len(texts)


def pack(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         longest: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece, which is a whole sequence: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (always 0), bucket (log2 of the length) and, if asked for, ids (little-endian unsigned 32-bit numbers).

    A null or empty text is the end token alone. Null and repeated ids keep their
    rows, each packed by itself; an empty table gives no rows; other columns are
    not read. sequence_id comes from the partition and row of a piece, so it is
    unique, and the same again for the same stored input.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path(TOKENIZER)
    fields = "__id {}, start long, length long, ids_crc32 long, doc_tokens long".format(
        docs.schema[id_col].dataType.simpleString()) + (", ids binary" if with_ids else "")
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        enc = encoder(tokenizer_path)
        for b in batches:
            texts = b.column("__text").to_pylist()
            for first, last in slices(texts):
                rows, start, length, crc, total, ids = [], [], [], [], [], []
                for i, raw in enumerate(enc.encode(texts[first:last]), first):
                    raw += end
                    at, n = 0, len(raw) // 4
                    for size in piece_lengths(n, longest):
                        piece = raw[4 * at:4 * (at + size)]
                        rows.append(i), start.append(at), length.append(size), total.append(n)
                        crc.append(zlib.crc32(piece))
                        if with_ids:
                            ids.append(piece)
                        at += size
                cols = [b.column("__id").take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, length, crc, total))]
                names = ["__id", "start", "length", "ids_crc32", "doc_tokens"]
                for at in range(0, len(rows), 20_000):
                    part = [c.slice(at, 20_000) for c in cols]
                    if with_ids:
                        part.append(pa.array(list(islice(ids, at, at + 20_000)), pa.binary()))
                    yield pa.RecordBatch.from_arrays(part, names=names + ["ids"] * with_ids)

    pieces = bounded_batches(docs).select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text")).mapInArrow(run, fields)
    out = pieces.select(F.col("__id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
                        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                        F.round(F.log2("length")).cast("int").alias("bucket"), *(["ids"] if with_ids else []))
    return out


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The pieces as Parquet, one folder per length, so that a reader draws whole buckets of equal lengths."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(path)
