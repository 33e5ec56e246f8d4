import hashlib
import random

import pytest

from docweave.llm import suffix_dedup

LENGTH = suffix_dedup.LENGTH


def brute_force(texts):
    """Bytes removed, spans and digest of each text, in the order given."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - LENGTH + 1):
            string = data[i:i + LENGTH]
            if string in seen:
                gone[i:i + LENGTH] = b"\1" * LENGTH
            seen.add(string)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(gone)))
        out.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def make_texts():
    draw = random.Random(2)
    passage = "".join(draw.choice("abcdefg é\n") for _ in range(400))
    texts = []
    for i in range(60):
        own = "".join(draw.choice("hijklmnop ") for _ in range(draw.randrange(250)))
        begin = draw.randrange(200)
        texts.append(own + passage[begin:begin + draw.choice([50, 99, 100, 101, 160])] + own[::-1])
    return [*texts, None, "", "a" * 900, "ab" * 300, passage, passage, "x" * 99, "x" * 100, passage[:150] + "!" + passage[150:]]


@pytest.mark.parametrize("bucket_bytes", [2 << 20, 600])
def test_matches_brute_force(spark, monkeypatch, bucket_bytes):
    """With small buckets, hot minimizers take the grouped path."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket_bytes)
    texts = make_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = [tuple(r)[1:] for r in suffix_dedup.dedup(docs).orderBy("doc_id").collect()]
    assert found == brute_force(texts)


def test_repeated_rows_are_one_document(spark):
    text = "".join(random.Random(4).choices("abcd ", k=300))
    docs = spark.createDataFrame([(None, text), (5, text), (5, text)], "doc_id long, text string")
    found = sorted((tuple(r) for r in suffix_dedup.dedup(docs).collect()), key=repr)
    assert [(r[0], r[2]) for r in found] == [(5, 300), (5, 300), (None, 0)]


def test_empty_table(no_docs):
    assert suffix_dedup.dedup(no_docs).count() == 0


def test_merged_shards_find_all_repeats():
    draw = random.Random(1)
    base = bytes(draw.choice(b"abcd ") for _ in range(400))
    strings = []
    for _ in range(37):
        begin = draw.randrange(250)
        string = bytearray(base[begin:begin + draw.randrange(100, 150)])
        if draw.random() < 0.5:
            string[draw.randrange(len(string))] = ord("x")
        strings.append(bytes(string))
    strings += [b"a" * 170, b"ab" * 90]
    import numpy as np

    counts = np.array([len(s) - LENGTH + 1 for s in strings])
    seen = set()
    for string, found, n in zip(strings, suffix_dedup.repeated_starts(strings, counts), counts, strict=True):
        wanted = []
        for i in range(n):
            if string[i:i + LENGTH] in seen:
                wanted.append(i)
            seen.add(string[i:i + LENGTH])
        assert found.tolist() == wanted


def test_work_follows_bytes_not_strings():
    """Many short strings cost about as much as few long ones with as many bytes and repeats."""
    import time

    import numpy as np

    base = bytes(random.Random(3).choices(b"abcd ", k=20_000))

    def seconds(size):
        strings = [base[at:at + size] for at in range(0, len(base) - size + 1, size)] * (1_200_000 // len(base))
        counts = np.array([len(s) - LENGTH + 1 for s in strings])
        begin = time.process_time()
        found = suffix_dedup.repeated_starts(strings, counts)
        assert sum(map(len, found)) == counts.sum() - counts.sum() * len(base) // 1_200_000
        return time.process_time() - begin

    assert seconds(200) < 2 * seconds(10_000)
