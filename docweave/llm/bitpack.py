"""Token ids in fixed-width bit packing.

A file is a Parquet folder, so that Spark's committer writes it and a lost task leaves nothing
behind. A row is a block of whole documents in ascending ``doc_id``: the ids of the block as one
stream of ``bits`` bits each, least significant bit first, and for each of its documents the number
of ids; ``before`` is the number of ids in the earlier blocks of its part. ``bits`` is the least number that holds every id of the vocabulary. Ids start at multiples of
``bits``, so any range is unpacked by shifts on whole arrays without reading what lies before it.

Texts are range-partitioned before they are encoded, so that only texts are shuffled. A block ends
at the first document that fills it; a longer document is a block of its own.

Defined results: a null or empty text has only the end id. A null ``doc_id`` comes first. Rows that
repeat a ``doc_id`` follow one another in the order of their texts. An empty table gives an empty
result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.shared import Texts, parked, slices

END_ID = 1
BLOCK_IDS = 1 << 18
CACHED_WORDS = 400_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def bits_for(vocabulary_size: int) -> int:
    return max(int(vocabulary_size - 1).bit_length(), 1)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids of ``bits`` bits each, least significant bit first, padded to whole bytes."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    places = np.arange(bits, dtype=np.uint32)
    return np.packbits(((ids.astype(np.uint32)[:, None] >> places) & 1).astype(np.uint8), bitorder="little").tobytes()


def unpack(packed: bytes | memoryview, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from place ``start`` on."""
    data = np.frombuffer(packed, np.uint8)
    if bits in (8, 16, 32):
        width = bits // 8
        return data[start * width:(start + count) * width].view(f"<u{width}").astype(np.uint32)
    first = (start + np.arange(count, dtype=np.int64)) * bits
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    value = np.zeros(count, np.uint64)
    for k in range((bits + 14) // 8):
        value |= padded[first // 8 + k] << np.uint64(8 * k)
    return ((value >> (first % 8).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


# How the vocabulary's file splits a normalised text, and what of it plain words need.
_SPLIT_OF_FILE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PLAIN_WORD = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
_PLAIN_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if it prints, else one from 256 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(others)}


class _Vocabulary:
    """A tokenizer, and whether plain words may go to its model without its normaliser and splitter."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        own = json.loads(self.tokenizer.to_str())
        steps = [n["type"] for n in (own["normalizer"] or {}).get("normalizers", [])]
        split = [p.get("pattern") for p in (own["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.plain = steps == ["NFC", "Replace", "Lowercase"] and split == [{"Regex": _SPLIT_OF_FILE}, None]
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.words, self.old_words, self.parts = {}, {}, {}

    def of_part(self, part: str) -> bytes:
        # Printed ASCII characters stand for themselves.
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        ids = np.array([t.id for t in self.tokenizer.model.tokenize(spelled)], "<u4").tobytes()
        self.parts[part] = ids
        return ids

    def of_plain(self, word: str) -> bytes:
        """Ids of a word of ASCII and precomposed Latin letters, which lower-casing alone normalises."""
        word = word.lower()
        ids = self.parts.get(word)  # a part by itself is split no further
        if ids is not None:
            return ids
        parts = _PLAIN_PART.findall(word)
        return b"".join([self.parts.get(p) or self.of_part(p) for p in parts])

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of the words. Those not met for longest are forgotten."""
        fresh = [w for w in words if w not in self.words]
        if len(self.words) + len(fresh) > CACHED_WORDS:
            self.old_words, self.words = self.words, {}
            fresh = words
        if len(self.parts) > CACHED_WORDS:
            self.parts = {}
        rest = []
        for word in fresh:
            ids = self.old_words.get(word)
            if ids is None:
                spelled = word.decode()
                if self.plain and "<|" not in spelled and _PLAIN_WORD.fullmatch(spelled):
                    ids = self.of_plain(spelled)
                else:
                    rest.append((word, spelled))
                    continue
            self.words[word] = ids
        found = self.tokenizer.encode_batch([spelled for _, spelled in rest], add_special_tokens=False)
        for (word, _), encoded in zip(rest, found, strict=True):
            self.words[word] = np.array(encoded.ids, "<u4").tobytes()
        return list(map(self.words.__getitem__, words))


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> _Vocabulary:
    """One for each Python worker, which keeps it from task to task."""
    return _Vocabulary(path)


def distinct_words(texts: Texts, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words of different bytes, and for each word which of them it equals.

    Hashes find the equal words and their bytes confirm them: a word that only shares a hash stands alone.
    """
    _, place, slot = np.unique(texts.word_hashes(first, last), return_index=True, return_inverse=True)
    size, model = last - first, first[place][slot]
    word = np.repeat(np.arange(len(first)), size)
    at = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
    other = np.minimum(model[word] + at, len(texts.data) - 1)
    unlike = size != (last - first)[place][slot]
    unlike[word[texts.data[first[word] + at] != texts.data[other]]] = True
    alone = np.flatnonzero(unlike)
    slot[alone] = len(place) + np.arange(len(alone))
    return np.concatenate([place, alone]), slot


class WordEncoder:
    """Whole texts in the ids of a vocabulary whose tokens never cross ASCII white space.

    Words are met once per slice of texts and encoded once per worker; a text's ids are those of its words.
    """

    def __init__(self, path: str):
        self.vocabulary = _vocabulary(path)

    def encode(self, column: list[str | None] | pa.Array) -> list[bytes]:
        column = column if isinstance(column, pa.Array) else pa.array(column, pa.large_string())
        texts = Texts(column)
        first, last, owner = texts.words()
        if not len(first):
            return [b""] * len(column)
        place, slot = distinct_words(texts, first, last)
        data = texts.data.tobytes()
        words = [data[a:b] for a, b in zip(first[place].tolist(), last[place].tolist(), strict=True)]
        found = self.vocabulary.ids_of(words)
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.array([len(ids) // 4 for ids in found], dtype=np.int64)
        n = sizes[slot]
        ends = np.cumsum(n)
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[slot] - (ends - n), n) + np.arange(ends[-1])].tobytes()
        cuts = np.concatenate([[0], ends])[np.searchsorted(owner, np.arange(len(column) + 1))].tolist()
        return [ids[4 * a:4 * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_BLOCK = "part int, block int, before long, doc_ids array<long>, counts array<int>, bits int, n_ids long, packed binary"


def blocks(docs: DataFrame, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of encoded documents in ascending ``doc_id`` within and across partitions."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        end = np.array([END_ID], "<u4").tobytes()
        bits = bits_for(_vocabulary(path).size)
        number, before, part, doc_ids, held, size = 0, 0, 0, [], [], 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            return pa.record_batch([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                pa.array([before], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([[len(h) // 4 for h in held]], pa.list_(pa.int32())), pa.array([bits], pa.int32()),
                pa.array([len(ids)], pa.int64()), pa.array([pack(ids, bits)], pa.binary()),
            ], names=["part", "block", "before", "doc_ids", "counts", "bits", "n_ids", "packed"])

        for batch in batches:
            for begin, stop in slices(batch.column("text")):
                rows = batch.slice(begin, stop - begin)
                part = rows.column("part")[0].as_py()
                found = encoder.encode(rows.column("text"))
                for doc, ids in zip(rows.column("doc_id").to_pylist(), found, strict=True):
                    doc_ids.append(doc)
                    held.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= block_ids:
                        yield block()
                        number, before, doc_ids, held, size = number + 1, before + size, [], [], 0
        if held:
            yield block()

    # A document is told from others of its number by a hash, so that one number can fill many parts.
    order = [F.col("doc_id").asc_nulls_first(), F.col("mark")]
    ranged = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
        .repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    return ranged.mapInArrow(run, _BLOCK)


def with_starts(written: DataFrame) -> DataFrame:
    """Blocks of a file with ``start``, the ids of all blocks before. Only the sums of the parts are broadcast."""
    sizes = written.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("of_parts"))
    # One row for each shuffle partition of the writer.
    return written.join(F.broadcast(parts), "part").withColumn("start", F.col("of_parts") + F.col("before")).drop("of_parts")


def read_digests(written: DataFrame) -> DataFrame:
    """Each document of a file, unpacked: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, counts = batch.column("doc_ids")[row].values, np.asarray(batch.column("counts")[row].values)
                ends = np.cumsum(counts, dtype=np.int64)
                ids = unpack(batch.column("packed")[row].as_buffer(), batch.column("bits")[row].as_py(), 0, int(ends[-1]))
                raw = ids.astype("<u4").tobytes()
                sums = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.record_batch([
                    doc_ids, pa.array(batch.column("start")[row].as_py() + ends - counts),
                    pa.array(counts.astype(np.int64)), pa.array(sums, pa.int64()),
                ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return with_starts(written).select("doc_ids", "counts", "bits", "packed", "start").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def read_ids(written: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id`` and ``ids`` of wanted documents, unpacked alone from their blocks."""
    places = written.select(
        "part", "block", F.explode(F.arrays_zip(
            F.col("doc_ids").alias("doc_id"), F.col("counts").alias("n"),
            F.transform("counts", lambda _, i: F.aggregate(F.slice("counts", 1, i), F.lit(0), lambda a, b: a + b)).alias("at"),
        )).alias("d"),
    ).select("part", "block", "d.doc_id", "d.n", "d.at").join(wanted, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                unpack(packed.as_buffer(), bits.as_py(), at.as_py(), n.as_py()).astype(np.int32)
                for packed, bits, at, n in zip(*(batch.column(c) for c in ("packed", "bits", "at", "n")), strict=True)
            ]
            yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return places.join(written.select("part", "block", "bits", "packed"), ["part", "block"]).select(
        "doc_id", "bits", "packed", "at", "n"
    ).mapInArrow(run, "doc_id long, ids array<int>")


def written_and_read(docs: DataFrame, path: str) -> DataFrame:
    """Encode ``docs`` into a file in the shared folder and read every document back from it."""
    return read_digests(parked(blocks(docs, path), "token-ids"))
