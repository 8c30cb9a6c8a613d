"""Quality rules, exact dedup and license scans beside brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, license_scan, quality_rules

GAP = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, words string, kept string"
CLEAN = (
    "The ship of the harbour sails to an island in the north and comes back with a load of wood. "
    "Nobody knew why its captain, who was born on that coast, never spoke about what he had seen there. "
    "For years people asked him, but he would only smile, light his pipe and look out at the grey sea."
)
TEXTS = [
    None, "", " \n\t", "one two three", CLEAN, CLEAN, CLEAN.lower(), "a b c a b c a b c", "x\ny\nx\n\nx",
    "# * $ % & | < >", "word " * 400, "über naïve 中文 " * 30, CLEAN + "\nMIT License", "spdx-license-identifier: Apache-2.0",
    "Licensed under the GNU General Public License version 3, see the MIT license.", "l" * 70_000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text, "w", "k") for i, text in enumerate(TEXTS)]
    rows += [(None, CLEAN, None, None), (4, CLEAN, "other", None), (4, CLEAN, "other", None)]
    return spark.createDataFrame(rows, SCHEMA)


def repeated(words):
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    return len({i + k for places in windows.values() if len(places) > 1 for i in places for k in range(3)})


def test_quality_counts(docs):
    for row, (text,) in zip(quality_rules.quality_rules(docs).collect(), docs.select("text").collect()):
        text = text or ""
        words = GAP.findall(text)
        lines = [line for line in text.split("\n") if GAP.search(line)]
        n = repeated(words)
        expected = (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), n,
            len(words) < 50 or 100 * n > 50 * len(words),
        )
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == expected
        assert not (row.kept and row.base_failed)


def test_quality_keeps_clean_rows_whole(docs):
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 10 not in ids and 0 not in ids and 12 in ids


def test_quality_judges_stop_words_by_share_and_script(spark):
    russian = " ".join(f"слово{i} и ещё" for i in range(40))
    junk = " ".join(["a", *(f"qx{chr(97 + i % 26)}{chr(97 + i // 26)}zv" for i in range(120))])
    prose = " ".join(f"the thing{chr(97 + i % 26)}{chr(97 + i // 26)} of" for i in range(200))
    uri = f"{prose} data:image/png;base64,{'QkJ' * 340}"
    mostly = f"{prose} {'QkJ' * 40_000}"
    texts = [russian, junk, prose, uri, mostly]
    rows = quality_rules.quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.kept for r in sorted(rows, key=lambda r: r.doc_id)] == [True, False, True, True, False]
    assert rows[0].stop_word_ratio is None and not any(r.base_failed for r in rows)


def test_quality_sql(spark, docs):
    unique = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    connection = duckdb.connect()
    documents = unique.select("doc_id", "text").toPandas()  # noqa: F841
    answer = connection.execute(quality_rules.OP3_SQL)
    columns = [c[0] for c in answer.description]
    ours = quality_rules.quality_rules(unique).select(*columns).collect()
    assert Counter(map(tuple, ours)) == Counter(answer.fetchall())


def test_exact_dedup(docs):
    rows = exact_dedup.exact_dedup(docs).collect()
    groups = defaultdict(list)
    for doc_id, text in docs.select("doc_id", "text").collect():
        groups[hashlib.sha256((text or "").encode()).hexdigest()].append(doc_id)
    assert len(rows) == docs.count()
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert all(kept[sha] == 1 for sha in groups)
    for r in rows:
        own = groups[r.text_sha256]
        assert r.group_size == len(own) and r.keep_id == max(d for d in own if d is not None)


def test_exact_dedup_keeps_one_row_with_all_columns(docs):
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({r.text or "" for r in docs.collect()})
    assert [r.doc_id for r in rows if r.text == CLEAN] == [5]


def test_a_hot_text_leaves_one_row_per_run(spark):
    docs = spark.range(5000, numPartitions=16).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    rows = exact_dedup.exact_dedup(docs).filter("kept").collect()
    assert [(r.doc_id, r.group_size) for r in rows] == [(4999, 5000)]


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def test_license_scan(docs):
    rules = license_scan.signatures()
    assert len(rules) > 200
    for row, (text,) in zip(license_scan.license_scan(docs).collect(), docs.select("text").collect()):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        starts, labels = [], set()
        for phrase, label in license_scan.BASE.items():
            own = phrase.split()
            found = [i for i in range(len(words)) if words[i : i + len(own)] == own]
            starts += found
            labels |= {label} if found else set()
        joined, hits = f" {' '.join(words)} ", []
        for rule in rules:
            if rule.keyword in words:
                for m in re.finditer(f"(?<= )({rule.pattern})(?= )", joined):
                    first = joined[: m.start()].count(" ") - 1
                    hits.append((first, first + m[1].count(" "), rule.priority, rule.label))

        def inside(a, b):
            return b[0] <= a[0] and a[1] <= b[1] and (b[2], b[0] - b[1]) < (a[2], a[0] - a[1])

        kept = sorted(a for a in hits if not any(inside(a, b) for b in hits))
        assert sorted((d.first, d.last, d.priority, d.label) for d in row.detections) == kept
        assert (row.n_words, row.n_base) == (len(words), len(starts))
        assert (row.first_word, row.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert row.base_labels == ",".join(sorted(labels))
        assert row.labels == ",".join(sorted(labels | {k[3] for k in kept}))
        assert 0 <= row.score <= 1 and (row.score > 0) == bool(kept or starts)


@pytest.mark.parametrize("operator", [quality_rules.quality_rules, exact_dedup.exact_dedup, license_scan.license_scan, quality_rules.keep_good, exact_dedup.drop_copies])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).collect() == []
