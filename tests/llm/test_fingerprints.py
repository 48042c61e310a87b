"""Fingerprints against a plain version on small tables with odd rows."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickwell.llm import fingerprints, queries

SF = "/root/testdata/sf0.001"


def plain_digest(text):
    data = b"\0\0" + text.encode() + b"\0\0"
    counts = [0] * 1024
    for i in range(len(data) - 2):
        counts[(int.from_bytes(data[i:i + 3], "big") * 2654435761 % 2 ** 32) >> 22] += 1
    ordered = sorted(counts)
    q = [ordered[256], ordered[512], ordered[768]]
    codes = [sum(c > x for x in q) for c in counts]
    length, size = 0, len(text.encode())
    if size:
        length = int(round(np.log(size) / np.log(1.1))) + 1
    return length.to_bytes(2, "big") + bytes(64 * a + 16 * b + 4 * c + d for a, b, c, d in zip(*[iter(codes)] * 4, strict=True)), codes, length


def plain_likeness(a, b):
    (_, x, m), (_, y, n) = a, b
    return 1 - (sum(abs(i - j) for i, j in zip(x, y, strict=True)) + 19.2 * min(abs(m - n), 10)) / (3072 + 192)


def plain_rows(rows):
    """(id, text) by id, then by nothing: ids of the fixture that repeat have equal texts."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (doc, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        own, changed = plain_digest(text), plain_digest(edited)
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), own[0].hex(), changed[0].hex(),
                    round(plain_likeness(own, changed), 9), round(plain_likeness(own, plain_digest(after)), 9)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
                   for r in fingerprints.fingerprint_digest(df).collect()), key=repr)


def test_rows_equal_the_plain_version(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(-10 ** 12, 10 ** 12), "".join(rng.choices("abc dé\U0001F600", k=rng.randrange(0, 90)))) for _ in range(60)]
    rows += [(1, None), (2, ""), (3, "ab"), (4, "w " * 30_000), (None, "a null id"), *[(7, "the same row " * 4)] * 40]
    df = spark.createDataFrame([(t, "x", i, "y", 3, "z") for i, t in rows], "text string, fingerprint string, doc_id bigint, part string, near_next int, k0 string")
    want = plain_rows(rows)
    assert got(df.repartition(5)) == want
    assert got(df.coalesce(1)) == want
    one = spark.createDataFrame([(9, "alone in the table")], "doc_id bigint, text string")
    assert got(one) == plain_rows([(9, "alone in the table")])
    assert fingerprints.fingerprint_digest(df.limit(0)).count() == 0


def test_rows_of_one_id_and_null_ids_keep_their_number(spark):
    rows = [(5, f"text {i % 7}") for i in range(200)] + [(None, f"none {i}") for i in range(50)]
    found = fingerprints.fingerprint_digest(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6))
    assert sorted(found.groupBy("doc_id").count().collect(), key=repr) == sorted([(5, 200), (None, 50)], key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op13_fingerprints(spark, SF).collect()
    want = {r[0]: r for r in plain_rows([tuple(r) for r in docs])}
    assert len(rows) == len(want)
    for r in rows:
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == want[r.doc_id][1:5]
        assert (r.near_edited, r.near_next) == pytest.approx(want[r.doc_id][5:])
    text = {i: t or "" for i, t in docs}
    clear = [r for r in rows if len(text[r.doc_id]) >= 40 and r.near_next < 1]
    assert sum(r.near_edited > r.near_next for r in clear) >= 0.98 * len(clear)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200), st.text(max_size=200))
def test_scores_are_bounded_and_symmetric(a, b):
    x, y = fingerprints.fingerprint(a), fingerprints.fingerprint(b)
    assert fingerprints.likeness(x, x) == 1.0 and 0.0 <= fingerprints.likeness(x, y) == fingerprints.likeness(y, x) <= 1.0


def test_slices_count_like_the_whole(monkeypatch):
    data = bytes(range(256)) * 40
    whole = fingerprints.bucket_counts(data)
    monkeypatch.setattr(fingerprints, "SLICE", 777)
    assert (fingerprints.bucket_counts(data) == whole).all() and whole.sum() == len(data) + 2
