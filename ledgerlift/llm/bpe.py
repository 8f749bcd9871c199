"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash cuts texts into chunks wherever they stand, so that passages which documents share are cut alike. Chunks
that several texts hold are encoded once. A chunk's ragged ends cannot be trusted: what stands before or after them may
change their tokens. The joins between chunks are therefore re-encoded, each from the last place in one chunk to the
first in the next at which the encoding of the whole text provably agrees with the chunks' own: between a visible
character and the white space after it no pre-token can continue. What lies between two such places is encoded the
same alone as within the text, so the result is that of encoding the whole text at once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.bits import BITMAP
from ledgerlift.llm.common import cut_lineage, whole_text
from ledgerlift.llm.packing import _byte_letters

WINDOW, MEAN_CHUNK, LEAST_BODY = 8, 1024, 96
FILTER_BITS_LEAST, FILTER_BITS_MOST = 2**22, 2**27

#: Fixed value: the pattern by which the byte-level vocabulary splits text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteCodec:
    """Ids as the tokenizers library gives them for a byte-level BPE file, and their bytes.

    A rank encoder over the same vocabulary does the merges. Texts that may hold special tokens, or characters on which
    the two libraries' Unicode rules may differ, go to the tokenizers library itself.
    """

    UNSURE = regex.compile(r"<\||[\x1c-\x1f\x85]|[^\x00-\x7f\xa0-ɏͰ-֏Ḁ-ỿ‐-‧‰-⁞₠-₿]")

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(path, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        letters = _byte_letters()
        special = self.exact.get_added_tokens_decoder()
        ranks = {bytes(letters[c] for c in token): number for token, number in vocab.items() if number not in special}
        self.ranked = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = max([*vocab.values(), *special]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, number in ranks.items():
            self.bytes_of[number] = token
        for number, token in special.items():
            self.bytes_of[number] = token.content.encode()
        self.decimal = [str(n) for n in range(size)]
        self.stored = np.dtype("<u2" if size <= 1 << 16 else "<u4")

    def encode(self, text: str) -> list[int]:
        if self.UNSURE.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def byte_codec(path: str) -> ByteCodec:
    return ByteCodec(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bodies_of(text: str) -> list[tuple[int, int]]:
    """(start, end) of each content-defined chunk without its ragged ends, in code points; short ones are left out.

    Both ends lie between a visible character and white space. What is between bodies are the joins.
    """
    if len(text) < LEAST_BODY:
        return []
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    mixed = points * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    rolled = mixed.copy()
    for k in range(1, WINDOW):
        rolled[k:] += mixed[:-k] * np.uint32(2 * k * k + 1)
    rolled *= np.uint32(0x85EBCA6B)
    cuts = np.flatnonzero(rolled < np.uint32(2**32 // MEAN_CHUNK)) + 1
    edges = np.concatenate([[0], cuts[(cuts >= WINDOW) & (cuts < len(points))], [len(points)]])
    before, here = points[:-1], points[1:]
    visible = ((before > 32) & (before < 127)) | ((before >= 0xC0) & (before < 0x250))
    safe = np.flatnonzero(visible & ((here == 32) | (here == 10))) + 1
    first = np.searchsorted(safe, edges[:-1], side="left")
    last = np.searchsorted(safe, edges[1:], side="right") - 1
    return [(int(safe[a]), int(safe[b])) for a, b in zip(first, last, strict=True) if a < b and safe[b] - safe[a] >= LEAST_BODY]


def _chunk_hash(text: str, start: int, end: int) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(text[start:end].encode("utf-8", "surrogatepass"))
    return ((value >> 64) & 0xFFFFFFFFFFFFFFFF) - (1 << 63), (value & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


def _shared_filter(shared: DataFrame) -> np.ndarray:
    """A bit set of the shared chunks' hashes. Its size is bounded; bits hit by chance only move a chunk needlessly."""
    bits = FILTER_BITS_LEAST
    count = shared.count()
    while bits < min(16 * count, FILTER_BITS_MOST):
        bits *= 2
    at = shared.select(F.pmod("high", F.lit(bits)).alias("bit"))
    made = at.groupBy(F.expr(f"bit div {BITMAP}").alias("block")).agg(F.bitmap_construct_agg(F.col("bit") % BITMAP).alias("bitmap"))
    out = np.zeros(bits // 8, np.uint8)
    for row in made.collect():  # at most FILTER_BITS_MOST / BITMAP rows of 4 KB
        out[row["block"] * BITMAP // 8 : (row["block"] + 1) * BITMAP // 8] = np.frombuffer(row["bitmap"], np.uint8)
    return np.unpackbits(out, bitorder="little").view(bool) if bits <= FILTER_BITS_LEAST else out


def _passes(filter_: np.ndarray, high: int) -> bool:
    if filter_.dtype == bool:
        return bool(filter_[high % len(filter_)])
    bit = high % (8 * len(filter_))
    return bool(int(filter_[bit >> 3]) >> (bit & 7) & 1)


def encode_digests(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row of `docs`; see `encode_texts`."""
    return _encoded(docs, vocabulary, id_col, text_col, digests=True)


def encode_texts(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string) for each row of `docs`.

    Null texts are empty ones: they have no ids. Texts that repeat are encoded once and joined back to all their rows.
    An empty table gives an empty result; other columns are not looked at.
    """
    return _encoded(docs, vocabulary, id_col, text_col, digests=False)


def _encoded(docs: DataFrame, vocabulary: str | None, id_col: str, text_col: str, digests: bool) -> DataFrame:
    path = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    text = whole_text(F.col(text_col))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("of"))

    def chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(of, place, *_chunk_hash(t, a, b)) for of, t in zip(batch["of"], batch["text"], strict=True) for place, (a, b) in enumerate(bodies_of(t))]
            yield pd.DataFrame(rows, columns=["of", "place", "high", "low"])

    chunks = base.select("of", "text").mapInPandas(chunk, "of binary, place int, high long, low long")
    chunks = cut_lineage(chunks.distinct())
    shared = chunks.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    filter_ = spark.sparkContext.broadcast(_shared_filter(shared))

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = {}
            for t in batch["text"]:
                for a, b in bodies_of(t):
                    key = _chunk_hash(t, a, b)
                    if key not in rows and _passes(filter_.value, key[0]):
                        rows[key] = t[a:b]
            yield pd.DataFrame([(*k, v) for k, v in rows.items()], columns=["high", "low", "chunk"])

    def encode_once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = byte_codec(path)
        for batch in batches:
            coded = [np.array(codec.encode(t), codec.stored).tobytes() for t in batch["chunk"]]
            yield pd.DataFrame({"high": batch["high"], "low": batch["low"], "coded": coded})

    once = base.select("text").mapInPandas(candidates, "high long, low long, chunk string")
    once = once.groupBy("high", "low").agg(F.first("chunk").alias("chunk")).join(shared.select("high", "low"), ["high", "low"])
    once = once.mapInPandas(encode_once, "high long, low long, coded binary")
    given = chunks.join(once, ["high", "low"]).groupBy("of").agg(F.collect_list(F.struct("place", "coded")).alias("given"))

    def squeeze(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            batch = batch.drop_duplicates("of")
            yield pd.DataFrame({"of": batch["of"], "packed": [press.compress(t.encode("utf-8", "surrogatepass")) for t in batch["text"]]})

    texts = base.select("of", "text").mapInPandas(squeeze, "of binary, packed binary").groupBy("of").agg(F.first("packed").alias("packed"))

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec, unpress = byte_codec(path), zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for of, packed, given in zip(batch["of"], batch["packed"], batch["given"], strict=True):
                text = unpress.decompress(packed).decode("utf-8", "surrogatepass")
                known = {} if given is None else {g["place"]: g["coded"] for g in given}
                ids, at = [], 0
                for place, (start, end) in enumerate(bodies_of(text)) if known else ():
                    if place in known:  # what stands between reused chunks, joins included, is encoded in place
                        ids += codec.encode(text[at:start])
                        ids += np.frombuffer(known[place], codec.stored).tolist()
                        at = end
                ids += codec.encode(text[at:])
                decoded = codec.decode(ids)
                if digests:
                    listed = ",".join([codec.decimal[i] for i in ids])
                    rows.append((of, len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
                else:
                    rows.append((of, ids, decoded))
            yield pd.DataFrame(rows, columns=["of", *names])

    names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    kinds = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    coded = texts.join(given, "of", "left").mapInPandas(assemble, f"of binary, {kinds}")
    return base.select("doc_id", "of").join(coded, "of").select("doc_id", *names)
