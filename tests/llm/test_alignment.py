"""Alignment of two vocabularies against a plain version with the libraries named in the contract."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickwell.llm import alignment, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoders():
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level alphabet: the others follow from 256 on
    alphabet = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def a(text):
        ids = coder.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(alphabet[c] for c in coder.id_to_token(i))) for i in ids]

    def b(text):
        out = []
        for i in pieces.encode(text):
            piece = pieces.id_to_piece(i)
            byte = piece.startswith("<0x") and len(piece) == 6
            out.append((i, bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()))
        return out
    return a, b


def plain(rows, encoders):
    docs, counts = [], Counter()
    for doc, text in rows:
        a, b = (encode(text) if text else [] for encode in encoders)
        if text and any(b"".join(t for _, t in side) != b" " + text.encode() for side in (a, b)):
            a = b = []
        at, ends = [], []
        for side in (a, b):
            stop = np.cumsum([len(t) for _, t in side]).tolist()
            at.append([(i, e - len(t), e) for (i, t), e in zip(side, stop, strict=True)])
            ends.append(set(stop))
        cuts = sorted(ends[0] & ends[1])
        linked = []
        for i, s, e in at[0]:
            linked += [(i, j) for j, p, q in at[1] if p < e and s < q]
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in at))
            start = cut
        counts.update(linked)
        docs.append((doc, len(a), len(b), len(cuts), linked, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    top = {}
    for (_, j), n in counts.items():
        top[j] = max(top.get(j, 0), n)
    return sorted([(doc, na, nb, g, len(li), sum(counts[p] == top[p[1]] for p in li), sum(counts[p] for p in li), sha) for doc, na, nb, g, li, sha in docs], key=repr)


ODD = ["plain words, twice: plain words", "", None, "a", " ", "  two  spaces ", "tab\tand\nline\r\n", "<|endoftext|> and </s> <unk> <0x41>", "▁piece mark", "été naïve Übergröße",
       "日本語のテキスト", "emoji \U0001F600\U0001F469‍\U0001F680 end", "zero\x00byte", "٣٤٥ عربي", "x" * 300, "1234567890 3.14159", "﻿mark", "é combining", "ﬁ ligature", "　wide space"]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_links", [40, 10 ** 6])
def test_rows_equal_the_plain_version(spark, encoders, block_links):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a null id with words"), (3, "a repeated id"), (3, "a repeated id")]
    df = spark.createDataFrame([(t, "x", i, 7, "y") for i, t in rows], "text string, block string, doc_id bigint, n int, pair string").repartition(3)
    assert got(alignment.alignment_digest(df, block_links=block_links)) == plain(rows, encoders)


def test_whole_table(spark, encoders):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    short = [(i, t) for i, t in docs if len(t or "") < 4000]
    found = queries.op11_alignment(spark, SF)
    assert found.count() == len(docs)
    few = spark.createDataFrame(short, "doc_id bigint, text string")
    assert got(alignment.alignment_digest(few, block_links=20_000)) == plain(short, encoders)


def test_long_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some words and numbers 12 " * 40_000)], "doc_id bigint, text string")
    row = alignment.alignment_digest(df).first()
    assert row.n_links == row.n_a + row.n_b - row.n_groups and row.n_best <= row.n_links
    assert alignment.alignment_digest(df.limit(0)).count() == 0


lengths = st.lists(st.integers(1, 9), min_size=1, max_size=40)


@settings(max_examples=200, deadline=None)
@given(lengths, st.integers(0, 2 ** 31))
def test_groups_and_links_of_any_intervals(a, seed):
    total, rng = sum(a), np.random.default_rng(seed)
    cuts = np.unique(np.r_[rng.integers(0, total, int(rng.integers(0, total + 1))), total])
    b = np.diff(np.r_[0, cuts[cuts > 0]])
    a = np.array(a)
    ga, gb = alignment.groups(a, b)
    ea, eb = np.cumsum(a), np.cumsum(b)
    common = sorted(set(ea.tolist()) & set(eb.tolist()))
    assert ga.tolist() == [sum(c <= e - n for c in common) for e, n in zip(ea, a, strict=True)]
    assert gb.tolist() == [sum(c <= e - n for c in common) for e, n in zip(eb, b, strict=True)]
    left, right = alignment.links(a, b)
    want = [(i, j) for i in range(len(a)) for j in range(len(b)) if ea[i] - a[i] < eb[j] and eb[j] - b[j] < ea[i]]
    assert list(zip(left.tolist(), right.tolist(), strict=True)) == want


def test_packed_numbers_come_back():
    values = np.array([0, 1, 255, 256, 70_000, 2 ** 32 - 1])
    assert alignment._unpacked(alignment._packed(values)).tolist() == values.tolist()
    assert len(alignment._unpacked(alignment._packed(values[:0]))) == 0
