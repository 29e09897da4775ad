"""Byte-level BPE through a table of distinct words.

Texts are split before every run of white space, where no token of the vocabulary's
pattern can cross. A block of documents lists its distinct words, sorted within buckets of
their hash; these lists are shuffled by bucket, compressed, and each distinct word of a
bucket is encoded and decoded once. Ids and decoded pieces go back to the blocks in the
order of the lists, and the places of the words in each document put them in order. A
block is bounded in bytes, and a frequent word travels once per block rather than once per
occurrence.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from orebed.llm.common import columns_of
from orebed.llm.words import _byte_letters

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes of text in a block of documents; one text alone may be larger.
BLOCK = 16 << 20
#: Distinct words whose ids a worker holds; beyond that it starts anew.
HELD = 1_000_000
#: The characters with the property White_Space.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_RARE = re.compile("[\t\x0b\x0c\r\x85\xa0  -     　]")
#: Texts of these characters alone are split alike by every library.
_PLAIN = re.compile("[ \n!-~À-ÖØ-öø-ÿ]+")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PARTS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ \n0-9{_LETTERS}]+|[ \n]+(?![^ \n])|[ \n]+"
)


def word_key(chunk: str) -> str:
    """A short name of a chunk: the leading space, which most have, is left out."""
    if chunk[0] == " " and chunk[1:2] != "\n":
        return chunk[1:]
    return chunk if chunk[0] == "\n" and chunk[1:2] != "\n" else "\n\n" + chunk


def chunk_of(key: str) -> str:
    """The chunk that a key names."""
    if key.startswith("\n\n"):
        return key[2:]
    return key if key.startswith("\n") else " " + key


def word_keys(text: str, special: list[str]) -> list[str]:
    """The keys of a text's chunks in order; special strings are chunks of their own."""
    if not text:
        return []
    found = [s for s in special if s in text]
    if found:
        parts = re.split("(" + "|".join(map(re.escape, found)) + ")", text)
        return [k for i, p in enumerate(parts) for k in ([word_key(p)] if i % 2 else word_keys(p, []))]
    if any(x in text for x in ("  ", " \n", "\n ", "\n\n")) or _RARE.search(text):
        return [word_key(c) for c in _CHUNK.findall(text)]
    first, *keys = text.replace("\n", " \n").split(" ")
    return [word_key(first), *keys] if first else keys


class ByteBpe:
    """Ids and decoded bytes of single chunks, by the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = str.maketrans(_byte_letters())
        back = {letter: byte for byte, letter in _byte_letters().items()}
        # The id-to-piece table: the bytes of every id of the vocabulary.
        size = self.tokenizer.get_vocab_size()
        self.piece = [bytes(back[c] for c in self.tokenizer.id_to_token(i) or "") for i in range(size)]

    def ids(self, chunk: str) -> list[int]:
        if _PLAIN.fullmatch(chunk) and chunk not in self.special:
            tokenize, ids = self.tokenizer.model.tokenize, []
            for part in _PARTS.findall(chunk):
                ids += [t.id for t in tokenize(part.encode().decode("latin-1").translate(self.letters))]
            return ids
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list]]:
    """The task's documents as blocks: number, doc_ids and texts."""
    ids, texts, size, number = [], [], 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if ids and size + len(text or "") > BLOCK:
                yield number, ids, texts
                ids, texts, size, number = [], [], 0, number + 1
            ids.append(doc_id)
            texts.append(text)
            size += len(text or "")
    if ids:
        yield number, ids, texts


def _packed(texts: list) -> tuple[list[int], bytes]:
    raw = [t.encode() if t else b"" for t in texts]
    return [len(r) for r in raw], b"".join(raw)


def word_lists(texts: list, special: list[str], buckets: int) -> list[list[str]]:
    """The keys of the texts' distinct words, sorted, by bucket of their hash."""
    keys: set[str] = set()
    for text in texts:
        keys.update(word_keys(text, special))
    out: list[list[str]] = [[] for _ in range(buckets)]
    for key in sorted(keys):
        out[zlib.crc32(key.encode()) % buckets].append(key)
    return out


def _listed(keys: list[str]) -> bytes:
    """Strings as their lengths in bytes and their bytes."""
    raw = [k.encode() for k in keys]
    return np.array([len(r) for r in raw], "<u4").tobytes() + b"".join(raw)


def _unlisted(data: bytes, n: int) -> list[str]:
    ends = 4 * n + np.cumsum(np.frombuffer(data, "<u4", n), dtype=np.int64)
    at, out = 4 * n, []
    for end in ends.tolist():
        out.append(data[at:end].decode())
        at = end
    return out


_LIST = "block long, bucket int, digest string, n int, data binary"


def _words(path: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special, pack = byte_bpe(path).special, zstandard.ZstdCompressor(level=3)
        for number, _, texts in _blocks(batches):
            # The digest tells whether the halves of a block are of the same texts.
            digest = hashlib.md5(_packed(texts)[1]).hexdigest()
            rows = [(number, k, digest, len(x), pack.compress(_listed(x))) for k, x in enumerate(word_lists(texts, special, buckets)) if x]
            rows = rows or [(number, 0, digest, 0, pack.compress(b""))]
            types = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                names=["block", "bucket", "digest", "n", "data"],
            )

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for number, ids, texts in _blocks(batches):
        lengths, raw = _packed(texts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([pack.compress(raw)], pa.binary()),
            ],
            names=["block", "doc_ids", "lengths", "data"],
        )


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = byte_bpe(path), {}
        pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in batches:
            coded, places, texts = [], [], []
            for n, data in zip(batch.column("n").to_pylist(), batch.column("data").to_pylist(), strict=True):
                ids, at, other = [], [], []
                for i, key in enumerate(_unlisted(unpack.decompress(data), n)):
                    found = known.get(key)
                    if found is None:
                        chunk = chunk_of(key)
                        numbers = bpe.ids(chunk)
                        decoded = b"".join([bpe.piece[x] for x in numbers]).decode("utf-8", "replace")
                        found = (",".join(map(str, numbers)), None if decoded == chunk else decoded)
                        if len(known) > HELD:
                            known.clear()
                        known[key] = found
                    ids.append(found[0])
                    if found[1] is not None:
                        at.append(i)
                        other.append(found[1])
                coded.append(pack.compress("\n".join(ids).encode()))
                places.append(at)
                texts.append(other)
            columns = [batch.column(c) for c in ("block", "bucket", "digest", "n")]
            columns += [pa.array(coded, pa.binary()), pa.array(places, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "bucket", "digest", "n", "ids", "at", "decoded"])

    return run


def _assemble(path: str, buckets: int):
    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        bpe, unpack = byte_bpe(path), zstandard.ZstdDecompressor()
        row = texts.to_pylist()[0]
        raw = unpack.decompress(row["data"])
        lists = {x["bucket"]: x for x in words.to_pylist()}
        if {x["digest"] for x in lists.values()} != {hashlib.md5(raw).hexdigest()}:
            raise ValueError("the input gave other rows when read again; write it to a table first")
        ends = np.cumsum(row["lengths"]).tolist()
        docs = [raw[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)]
        index: dict[str, int] = {}
        ids: list[bytes] = []
        pieces: list[bytes] = []
        for bucket, keys in enumerate(word_lists(docs, bpe.special, buckets)):
            if keys:
                found = lists[bucket]
                base = len(ids)
                index.update(zip(keys, range(base, base + len(keys)), strict=True))
                ids += unpack.decompress(found["ids"]).split(b"\n")
                pieces += [chunk_of(k).encode() for k in keys]
                for at, text in zip(found["at"], found["decoded"], strict=True):
                    pieces[base + at] = text.encode()
        sizes = [x.count(b",") + 1 for x in ids]
        out = []
        for doc_id, text in zip(row["doc_ids"], docs, strict=True):
            numbers = list(map(index.__getitem__, word_keys(text, bpe.special)))
            joined = hashlib.sha256(b",".join(map(ids.__getitem__, numbers))).hexdigest()
            decoded = hashlib.sha256(b"".join(map(pieces.__getitem__, numbers))).hexdigest()
            out.append((doc_id, sum(map(sizes.__getitem__, numbers)), joined, decoded))
        types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return run


def encoded_words(docs: DataFrame, path: str, buckets: int) -> DataFrame:
    """Rows (block, bucket, digest, n, ids, at, decoded): the words of each block's lists, encoded.

    ids are decimal, joined by commas, one word a line, compressed; decoded holds the texts of
    the words at the places `at`, whose decoded text is not the word itself.
    """
    dealt = docs.mapInArrow(_words(path, buckets), _LIST).repartition("bucket")
    return dealt.mapInArrow(
        _encode(path), "block long, bucket int, digest string, n int, ids binary, at array<int>, decoded array<string>"
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The ids of every whole text, as decimals joined by commas, and the text that they decode
    to, both as SHA-256. Null and empty texts have no ids. Rows with null or repeated doc_ids
    are documents of their own; other columns are left out.
    """
    narrow = columns_of(docs, doc_id="long", text="string")
    # As many buckets as shuffle partitions: what the user sets for data of this size.
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = narrow.mapInArrow(_texts, "block long, doc_ids array<long>, lengths array<long>, data binary")
    both = texts.groupBy("block").cogroup(encoded_words(narrow, path, buckets).groupBy("block"))
    return both.applyInArrow(_assemble(path, buckets), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
