"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

A text gets the library's form (blanks become ``\\u2581``, one is put in front) and is cut into
words, which no piece of the vocabulary crosses. Each task looks its words up in a table of those it
has met and encodes the new ones together: words of equal length are a matrix of code points, the
hashes of all their substrings probe the sorted hashes of the pieces, and the search advances over
the columns for all words at once, keeping the best score and the length of the last piece at each
place. A character that no piece covers falls back to its bytes.

A piece's score is taken from the file ("stored"), or from its rank by Zipf's law ("rank"): files of
merge order hold no log-probabilities, so the rank stands for the frequency. Of equally good
segmentations the one with the longest last piece wins.

Defined results: a null or empty text has no ids. Texts decode to themselves exactly. Rows that
repeat are encoded alike. An empty table gives an empty result; other columns pass unchanged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docweave.llm.shared import mixed, slices

BLANK = "▁"
CACHED_WORDS = 300_000
CELLS = 1 << 18
_BASE = np.uint64(0x9FB21C651E98DF25)
_WORD = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=64)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, pow(int(_BASE), -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Pieces:
    """A vocabulary with the hashes of its pieces in order."""

    def __init__(self, path: str, scores: str = "rank"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = np.array([model.is_byte(i) or model.is_unknown(i) or model.is_control(i) or model.is_unused(i) for i in range(size)])
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(size):
            if model.is_byte(i):
                self.byte_ids[int(names[i][3:5], 16)] = i
        normal = np.flatnonzero(~special)
        stored = np.array([model.get_score(int(i)) for i in normal])
        if scores == "stored":
            value = stored
        else:
            value = np.empty(len(normal))
            value[np.argsort(-stored, kind="stable")] = -np.log(np.arange(1, len(normal) + 1) + 1.0)
        self.longest = max(len(names[i]) for i in normal)
        keys = np.array([self._key(names[i]) for i in normal], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids, self.scores = keys[order], normal[order].astype(np.int32), value[order]
        self.unknown = float(value.min()) - 10.0
        self.bytes = [
            bytes([int(name[3:5], 16)]) if model.is_byte(i) else b"" if special[i] else name.replace(BLANK, " ").encode()
            for i, name in enumerate(names)
        ]
        if any(BLANK in names[i].lstrip(BLANK) for i in normal):
            raise ValueError("a piece of this vocabulary crosses words")

    @staticmethod
    def _key(piece: str) -> int:
        codes = np.array([[ord(c) for c in piece]], np.uint64)
        return int(_substrings(codes, codes.shape[1])[0, 0])

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.array([len(w) for w in words])
        order = np.argsort(lengths, kind="stable")
        begin = 0
        while begin < len(order):
            n = int(lengths[order[begin]])
            end = int(np.searchsorted(lengths[order], n, side="right"))
            end = min(end, begin + max(CELLS // n, 1))
            rows = order[begin:end]
            for row, ids in zip(rows.tolist(), self._search([words[r] for r in rows]), strict=True):
                out[row] = ids
            begin = end
        return out

    def _search(self, words: list[str]) -> list[bytes]:
        m, n = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(m, n)
        wide = codes.astype(np.uint64)
        longest = min(self.longest, n)
        ending = np.full((n, longest, m), -np.inf)  # score of the piece of each length that ends here
        piece = np.full((n, longest, m), -1, np.int32)
        for length in range(1, longest + 1):
            key = _substrings(wide, length)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            ending[length - 1:, length - 1] = np.where(hit, self.scores[at], -np.inf).T
            piece[length - 1:, length - 1] = np.where(hit, self.ids[at], -1).T
        lone = piece[:, 0] < 0
        ending[:, 0][lone] = self.unknown
        best = np.full((n + 1, m), -np.inf)
        best[0] = 0.0
        back = np.zeros((n + 1, m), np.int32)
        columns = np.arange(m)
        for j in range(1, n + 1):
            reach = min(j, longest)
            totals = (best[j - reach:j] + ending[j - 1, :reach][::-1])  # longest piece first
            pick = np.argmax(totals, axis=0)
            best[j] = totals[pick, columns]
            back[j] = reach - pick
        ids = np.full((n, m), -1, np.int64)
        at = np.full(m, n)
        while (at > 0).any():
            live = np.flatnonzero(at > 0)
            step = back[at[live], live]
            ids[at[live] - step, live] = piece[at[live] - 1, step - 1, live] + 1  # 0 marks a character without piece
            at[live] -= step
        return self._spelled(codes, ids.T)

    def _spelled(self, codes: np.ndarray, ids: np.ndarray) -> list[bytes]:
        row, place = np.nonzero(ids >= 0)
        found = (ids[row, place] - 1).astype("<i4")
        cuts = np.searchsorted(row, np.arange(len(ids) + 1)) * 4
        flat = found.tobytes()
        out = [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        for r in np.unique(row[found < 0]).tolist():
            parts = []
            for p in np.flatnonzero(ids[r] >= 0).tolist():
                if ids[r, p] == 0:
                    spelled = chr(int(codes[r, p])).encode("utf-8", "surrogatepass")
                    parts.append(self.byte_ids[list(spelled)].astype("<i4"))
                else:
                    parts.append(np.array([ids[r, p] - 1], "<i4"))
            out[r] = np.concatenate(parts).tobytes()
        return out


def _substrings(codes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all substrings of one length in each row of code points."""
    n = codes.shape[1]
    up, down = _powers(1 << max(n - 1, 1).bit_length())
    sums = np.zeros((codes.shape[0], n + 1), np.uint64)
    np.cumsum(mixed(codes + np.uint64(1)) * up[:n], axis=1, out=sums[:, 1:])
    return mixed((sums[:, length:] - sums[:, :n - length + 1]) * down[:n - length + 1] + np.uint64(length))


@lru_cache(maxsize=2)
def vocabulary(path: str, scores: str) -> Pieces:
    return Pieces(path, scores)


class Encoder:
    """Encodes texts with one table of words met so far."""

    def __init__(self, path: str, scores: str):
        self.pieces = vocabulary(path, scores)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [_WORD.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        fresh = list({w for words in split for w in words} - self.known.keys())
        if len(self.known) + len(fresh) > CACHED_WORDS:
            self.known = {}
            fresh = list({w for words in split for w in words})
        self.known.update(zip(fresh, self.pieces.encode_words(fresh), strict=True))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 bytes of the text that the ids stand for, without the blank put in front."""
        table = self.pieces.bytes
        return b"".join([table[i] for i in np.frombuffer(ids, "<i4").tolist()])[1:]


def encode(docs: DataFrame, model: str, scores: str = "rank") -> DataFrame:
    """``docs`` with ``ids``, the piece ids of each text."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, scores)
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                found = encoder.encode(part.column("text").to_pylist())
                sizes = np.array([len(f) // 4 for f in found], np.int32)
                ids = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                    pa.array(np.frombuffer(b"".join(found), "<i4")),
                )
                yield pa.record_batch([*part.columns, ids], names=[*names, "ids"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kept}, ids array<int>")


def decode(rows: DataFrame, model: str) -> DataFrame:
    """Rows with ``ids`` and, in ``text``, what they stand for."""
    rows = rows.drop("text")
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, "rank")
        for batch in batches:
            texts = [
                encoder.decode(np.asarray(ids.values, "<i4").tobytes()).decode() if ids.is_valid else None
                for ids in batch.column("ids")
            ]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*names, "text"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kept}, text string")


def digests(docs: DataFrame, model: str, scores: str = "rank") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_bytes, ids_crc32, decoded_crc32, round_trip."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, scores)
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                texts = batch.column("text").slice(begin, end - begin).to_pylist()
                found = encoder.encode(texts)
                plain = [(t or "").encode() for t in texts]
                decoded = [encoder.decode(f) for f in found]
                yield pa.record_batch([
                    batch.column("doc_id").slice(begin, end - begin),
                    pa.array([len(f) // 4 for f in found], pa.int64()), pa.array([len(p) for p in plain], pa.int64()),
                    pa.array([zlib.crc32(f) for f in found], pa.int64()),
                    pa.array([zlib.crc32(d) for d in decoded], pa.int64()),
                    pa.array([d == p for d, p in zip(decoded, plain, strict=True)]),
                ], names=["doc_id", "n_tokens", "n_bytes", "ids_crc32", "decoded_crc32", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_bytes long, ids_crc32 long, decoded_crc32 long, round_trip boolean"
    )
