import hashlib
import re
from collections import defaultdict

from docweave.llm import exact_dedup


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute_force(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[squeezed(text)].append((-len(text or ""), doc_id is None, doc_id))
    return {key: (min(held, key=lambda h: (h[0], h[1], h[2] or 0))[2], len(held)) for key, held in groups.items()}


def test_groups_match_brute_force(docs, rows):
    wanted = brute_force(rows)
    found = exact_dedup.groups(docs).collect()
    assert len(found) == len(rows)
    by_digest = {hashlib.sha256(key.encode()).hexdigest(): value for key, value in wanted.items()}
    for row in found:
        assert (row.keep_id, row.group_size) == by_digest[row.text_sha256]
    assert sum(row.kept for row in found) == len(wanted)


def test_frequent_digests_take_the_other_path_with_equal_results(docs):
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    few = exact_dedup.groups(docs, support=1e-3).select(columns).collect()
    split = exact_dedup.groups(docs, support=0.02).select(columns).collect()
    assert sorted(map(repr, few)) == sorted(map(repr, split))


def test_a_group_of_a_third_of_all_rows_is_frequent(spark):
    rows = spark.range(300).selectExpr("id AS doc_id", "IF(id % 3 = 0, ' same text', concat('text ', id)) AS text")
    digests = rows.select(exact_dedup.digest(rows.text).alias("__digest"), rows.doc_id.alias("__order"))
    frequent = exact_dedup.frequent_digests(digests, 0.05).collect()
    assert [(row["__size"], row["__best"]) for row in frequent] == [(100, 0)]


def test_first_of_each_keeps_one_row_with_its_columns(docs, rows):
    for support in (1e-3, 0.02):
        kept = exact_dedup.first_of_each(docs, support)
        assert kept.columns == docs.columns
        found = kept.collect()
        assert len(found) == len(brute_force(rows))
        assert len({squeezed(row.text) for row in found}) == len(found)


def test_empty_table_and_clashing_names(no_docs, spark):
    assert exact_dedup.groups(no_docs).count() == 0
    assert exact_dedup.first_of_each(no_docs).count() == 0
    odd = spark.createDataFrame([(1, "a", 5, True), (2, " a", 6, False)], "doc_id long, text string, group_size int, kept boolean")
    assert [tuple(r) for r in exact_dedup.first_of_each(odd).collect()] == [(2, " a", 6, False)]
