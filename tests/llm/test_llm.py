"""Training-data operators against brute force, on small tables with odd rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

import corpus_pipeline
from tickwell.llm import cover_tree, frames, jaccard, langid, licenses, mixing, ngram_lm, packing, pii, queries, subword, toxicity, vamana
from tickwell.llm.components import components

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, bucket string"


def texts():
    rng = np.random.default_rng(3)
    words = ["alpha", "Beta", "gamma", "delta", "eps", "zeta", "été", "x1"]
    base = " ".join(rng.choice(words, 60))
    rows = [base, base.upper(), base + " tail", None, "", " \t\n", "one two", "ONE  two", "a b c d e f", "word " * 30_000]
    rows += [" ".join(np.r_[base.split()[:k], rng.choice(words, 60 - k)]) for k in (58, 55, 50, 40)]
    rows += [" ".join(rng.choice(words, int(n))) for n in rng.integers(1, 80, 30)]
    rows += ["q" * 5_000, "mail a.b@c.d.ef now, ip 10.0.0.1 or 300.1.1.1.7.8.9, card 4111 1111 1111 1111, +1 (323) 555-8465"]
    return rows


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["s0", "s1", None][i % 3 if i % 2 else 0], 1, "x", "y") for i, t in enumerate(texts())]
    rows += [rows[0], (None, "a null id with some words in it", "en", "s0", 1, "x", "y"), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3).cache()


def test_every_operator_takes_empty_tables(spark):
    docs = spark.createDataFrame([], DOCUMENTS)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    for df in (pii.pii_digest(docs), toxicity.toxic_scores(docs, labels), licenses.license_scan(docs), ngram_lm.text_scores(docs), packing.pack(docs),
               cover_tree.near_duplicates(vectors), jaccard.similar_documents(docs), queries.mixed(docs), vamana.nearest(vectors, vectors), langid.languages(docs)):
        assert df.count() == 0


# --- personal data -----------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = True
            if kind == "ip":
                ok = all(int(p) <= 255 for p in m.group().split("."))
            elif kind == "card":
                luhn = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1]))
                ok = 12 <= len(digits) <= 19 and luhn % 10 == 0
            elif kind == "phone":
                ok = 9 <= len(digits) <= 15
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aZ9014.@+-() %é\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert [s for s in pii.spans(text) if s[0] in pii.BASE] == plain_spans(text)


def test_spans_of_whole_documents(documents):
    for row in pii.pii_digest(documents).join(documents.select("doc_id", "text"), "doc_id").collect():
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(row["text"] or ""))
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    found = pii.spans("see https://a.b/c. account no: 12345678, lives at 12 High Street, token = 'abcdefabcdefabcdef'")
    assert [k for k, _, _ in found] == ["url", "account", "address", "credential"]
    assert pii.redacted("to a@b.cd!") == "to <EMAIL>!"


# --- classifiers -------------------------------------------------------------------


def test_toxicity_and_language_on_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = toxicity.toxic_scores(docs, labels).join(labels, "doc_id").toPandas()
    held = scored[scored["held_out"]]
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(scored["doc_id"], scored["held_out"]))
    assert (held["predicted"] == held["toxic"]).mean() > 0.85 and scored["score"].between(0, 1).all()
    found = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.95


def test_training_takes_words_in_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 400, 60)) + (" slur" if i % 3 == 0 else "") for i in range(40)]
    labels = np.array([int(i % 3 == 0) for i in range(40)])
    whole = subword.fit_noisy_or(texts, labels, 4, 2)
    monkeypatch.setattr(subword.Trainer, "BLOCK", 7)
    cut = subword.fit_noisy_or(texts, labels, 4, 2)
    assert np.allclose(whole.embedding, cut.embedding) and np.allclose(whole.weight, cut.weight)


def test_toxicity_scores_as_it_was_trained(spark):
    """Several words of a small probability add up; repeats and order do not count, and long runs are cut as in training."""
    words = [f"w{i}" for i in range(12)] + ["x" * 150, "gem-" * 40]
    model = subword.fit_noisy_or([" ".join(words[i:i + 4]) for i in range(10)], np.array([0, 1] * 5), 4, 3)
    table = model.table()

    def plain(text):
        missed = 1.0
        for p in {p for w in set(text.lower().split()) for p in subword.pieces(w)}:
            score = subword.gram_means([p], table)[0] + model.bias
            missed *= 1 - 1 / (1 + math.exp(score[0] - score[1]))
        return 1 - missed

    texts = ["", words[0], " ".join(words), " ".join(words[::-1] * 3), "w1 w2 w3, (w3) W3"]
    score = toxicity.scorer(model.dump())
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(score("t")).collect()]
    assert np.allclose(got, [plain(t) for t in texts], rtol=1e-4, atol=1e-8) and got[2] > 2 * max(got[1], plain(words[5])) and got[2] == got[3]


def test_toxicity_without_labels_finds_nothing(documents, spark):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.toxic_scores(documents, labels).where("predicted = 1").count() == 0


def test_classifiers_on_odd_rows(documents, spark):
    labels = spark.createDataFrame([(0, 1), (2, 0), (5, None), (None, 1)], "doc_id bigint, toxic int")
    assert toxicity.toxic_scores(documents, labels).where("score BETWEEN 0 AND 1").count() == documents.count()
    rows = {r["doc_id"]: r for r in langid.languages(documents).where("doc_id IS NOT NULL").collect()}
    assert rows[3]["lang_pred"] == rows[4]["lang_pred"] == rows[5]["lang_pred"] == "und" and rows[0]["lang_pred"] in ("en", "de")


# --- licences ----------------------------------------------------------------------


def test_licenses_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(map(tuple, con.execute(licenses.oracle_sql()).fetchall()))
    assert sorted(map(tuple, licenses.license_scan(spark.read.parquet(f"{SF}/documents.parquet")).collect())) == want


def test_license_sequences_match_in_order(spark):
    grant, kept = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. ", "The above copyright notice and this permission notice shall be included in all copies."
    rows = spark.createDataFrame([(1, grant + "Other words.\n" + kept), (2, kept + "\n" + grant), (3, None), (None, "All rights reserved.")], "doc_id int, text string")
    found = {r["doc_id"]: r["licenses"] for r in licenses.license_scan(rows).collect()}
    assert found == {1: "MIT", 2: "", 3: "", None: "Proprietary"}


NOTICES = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "MIT": """Copyright (c) 2020 Some Body
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
}
NOTICES["BSD-3-Clause"] = NOTICES["BSD-2-Clause"] + """
3. Neither the name of Some Body Inc. nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission."""
NOTICES["GPL-2.0"] = NOTICES["GPL-3.0"].replace("version 3", "version 2").replace("This program", "Frobnicate").replace("software:", "software;")


for version in ("2.1", "3"):
    NOTICES[f"LGPL-{version if version != '3' else '3.0'}"] = NOTICES["GPL-3.0"].replace("GNU General", "GNU Lesser General").replace("version 3", f"version {version}")
NOTICES |= {
    "AGPL-3.0": NOTICES["GPL-3.0"].replace("GNU General", "GNU Affero General"),
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "ISC": """Copyright (c) 2019 Some Body. All rights reserved.

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software.""",
    "CC0-1.0": """To the extent possible under law, Some Body has waived all copyright
and related or neighboring rights to this work.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/.""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented.""",
    "BSL-1.0": """Distributed under the Boost Software License, Version 1.0.
   (See accompanying file LICENSE_1_0.txt or copy at
         https://www.boost.org/LICENSE_1_0.txt)""",
}
NOTICES["BSD-3-Clause/reserved"] = "Copyright (c) 2020, Some Body. All rights reserved.\n\n" + NOTICES["BSD-3-Clause"]


def test_licenses_of_whole_notices(spark):
    def shapes(t):
        yield t
        yield " ".join(t.split())
        yield "/*\n" + "\n".join((" * " + line).rstrip() for line in t.split("\n")) + "\n */\nint x;"
        yield "\r\n".join(("# " + line).rstrip() for line in t.split("\n"))
        yield "Some words without an end\n" + t + "\nfurther words"
        yield re.sub(r"(?m)^[1-3][.]", "  *", t)
    rows = [(f"{name}/{i}", text) for name, t in NOTICES.items() for i, text in enumerate(shapes(t))]
    got = licenses.license_scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {r["doc_id"]: r["licenses"] for r in got} == {i: i.split("/")[0] for i, _ in rows}


def test_phrases_beside_notices_are_kept(spark):
    rows = [(1, "Released under the MIT license\n" + NOTICES["GPL-3.0"]), (2, "Parts of the notice: you can redistribute it\nAll rights reserved\nand more")]
    got = licenses.license_scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {r["doc_id"]: (r["sentence_ids"], r["licenses"]) for r in got} == {1: ("mit-notice,gpl3-notice", "MIT,GPL-3.0"), 2: ("all-rights", "Proprietary")}


# --- language model ----------------------------------------------------------------


def test_elias_fano_finds_like_bisection():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 5), (10, 20), (1000, 50), (1000, 2**63), (5000, 10**6)):
        v = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        coded, _ = ngram_lm.EliasFano.load(np.concatenate(ngram_lm.EliasFano.encode(v).dump()), 0)
        assert (coded[np.arange(n)] == v).all()
        asked = np.concatenate([rng.integers(0, top, 200, dtype=np.uint64), v, v + np.uint64(1)])
        assert (coded.successor(asked) == np.searchsorted(v, asked)).all()


def test_common_pairs_stay_in_their_block(spark, monkeypatch):
    """A pair that makes up most tokens reaches no shard, and the scores are those of one large shard."""
    texts_ = [" ".join(["of the"] * 40 + [f"w{i % 50}"]) for i in range(300)] + ["of", "the", "of the", "", "the of"]
    frame = pd.DataFrame({"doc_id": [str(i) for i in range(len(texts_))], "text": texts_, "train": [zlib.crc32(str(i).encode()) % 10 != 0 for i in range(len(texts_))]})
    tokens = [ngram_lm.hashes(t) for t, train in zip(texts_, frame["train"], strict=True) if train]
    words, counts = np.unique(np.concatenate(tokens), return_counts=True)
    frequent, counts = words[counts >= 200], counts[counts >= 200]
    found = pd.concat(ngram_lm._pair_counts(frequent, [frame])).groupby("pair")["n"].sum()
    found = found[found >= 200].sort_index()
    common = ngram_lm.Common(frequent, counts, found.index.to_numpy(np.int64), found.to_numpy(np.int64), int(sum(map(len, tokens))), len(words))
    assert len(common.pairs) == 3  # of the, the of, and "of" at the beginning
    from pyspark import TaskContext
    monkeypatch.setattr(TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 0})()))
    rows = pd.concat(ngram_lm._deal(8, common, [frame]))
    assert rows["before"].map(len).sum() / 4 < 0.05 * sum(len(ngram_lm.hashes(t)) for t in texts_)
    monkeypatch.undo()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts_)], "doc_id int, text string").repartition(3)
    small, large = (ngram_lm.text_scores(df, shard_tokens=n).toPandas().sort_values("doc_id") for n in (1600, 10 ** 7))
    assert (small["n_known"].to_numpy() == large["n_known"].to_numpy()).all() and (small["n_tokens"].to_numpy() == large["n_tokens"].to_numpy()).all()
    assert np.allclose(small["base_score"], large["base_score"], atol=1e-6) and np.allclose(small["score"], large["score"], rtol=2e-3, atol=2e-3)


def test_levels_are_mapped_from_a_file_that_goes(tmp_path, monkeypatch):
    monkeypatch.setattr(ngram_lm.tempfile, "tempdir", str(tmp_path))
    opened, plain = [], np.memmap
    monkeypatch.setattr(ngram_lm.np, "memmap", lambda *a: opened.append(plain(*a)) or opened[-1])
    words, counts = np.arange(10, 500, 7, dtype=np.uint64), np.arange(1, 71)
    owner, before = np.repeat(np.arange(70), 3), np.tile(np.array([3, 50, 900], np.uint64), 70)
    built = ngram_lm.Trie.build(words, counts, owner, before, np.ones(210, np.int64), 5000, 70)
    trie = built.mapped()
    asked, after = np.repeat(np.r_[words, np.uint64(11)], 2), np.tile(np.array([50, 51], np.uint64), 71)
    for want, got in zip(built.lookup(asked, after), trie.lookup(asked, after), strict=True):
        assert np.array_equal(want, got)
    assert len(opened) == 1 and np.shares_memory(trie.joint.codes, opened[0]) and not list(tmp_path.iterdir())


@pytest.mark.parametrize("shard", [3_000_000, 40])
def test_text_scores_equal_plain_counts(documents, shard):
    rows = documents.select("doc_id", "text").collect()
    token = [(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), r["text"] or ""))) for r in rows]
    held = [r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows]
    train = [t for t, h in zip(token, held) if not h]
    c, pair = Counter(w for t in train for w in [*t, "</s>"]), Counter(p for t in train for p in zip(["<s>", *t], [*t, "</s>"]))
    n, v = sum(c.values()), len(c)
    k = ngram_lm.PRIOR / n
    want = []
    for r, t, h in zip(rows, token, held):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*t, "</s>"])
        score = sum(math.log10((pair[a, b] + k * (c[b] + 0.1)) / ((len(train) if a == "<s>" else c[a]) + k * (n + 0.1 * (v + 1)))) for a, b in zip(["<s>", *t], [*t, "</s>"]))
        want.append((-1 if r["doc_id"] is None else r["doc_id"], h, len(t) + 1, sum(c[w] > 0 for w in [*t, "</s>"]), n, base, score))
    got = ngram_lm.text_scores(documents, shard_tokens=shard).fillna({"doc_id": -1}).collect()
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got)), sorted(want)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-3, abs=1e-2)


# --- packing -----------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=200))
def test_encoder_gives_the_ids_of_the_tokenizer(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    if "t" not in _CODERS:
        _CODERS["t"], _CODERS["e"] = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.load_encoder()
    for case in (text, text + "<|endoftext|>" + text, "a" * 3000):
        assert _CODERS["e"](case) == _CODERS["t"].encode(case, add_special_tokens=False).ids


_CODERS = {}


def test_pieces_cover_documents_and_fill_sequences(documents):
    encode = packing.load_encoder()
    pieces = packing.pack(documents.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).toPandas()
    for doc, text in documents.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text").collect():
        ids, mine, at = [*encode(text or ""), 1], pieces[pieces["doc_id"] == doc].sort_values("start"), 0
        for p in mine.itertuples():
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert list(s["offset"]) == [0, *np.cumsum(s["length"])[:-1]] and s["length"].sum() <= 2048
    assert packing.pack(documents).groupBy("doc_id").count().count() == documents.select("doc_id").distinct().count()


# --- vectors -----------------------------------------------------------------------


def vectors(spark, n=400):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(8, 6))
    rows = [(i, (centers[i % 8] + rng.normal(size=6) * (0.05 if i % 3 else 1)).tolist(), [0, 0, 0, 1, None][i % 5]) for i in range(n)]
    rows += [(n + 1, rows[0][1], 0), (n + 2, [2 * x for x in rows[0][1]], 0), (n + 3, [0.0] * 6, 0), (n + 4, None, 0), (n + 5, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0),
             (n + 6, [float("nan")] + [1.0] * 5, 0), (n + 7, [1.0, 2.0], 0), (n + 8, [float("inf")] * 6, 0), (None, rows[1][1], 0)]
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, n_links string")


def fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("block", [2048, 16])
def test_near_duplicates_equal_all_pairs(spark, block):
    df = vectors(spark)
    rows = [r for r in df.collect() if r["vec_id"] is not None]
    links, near = Counter(), []
    for a, b in itertools.combinations(rows, 2):
        x, y = a["embedding"], b["embedding"]
        if a["label"] is not None and a["label"] == b["label"] and fine(x) and fine(y) and len(x) == len(y):
            if np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                links.update([a["vec_id"], b["vec_id"]])
                near.append((a["vec_id"], b["vec_id"]))
    root = {r["vec_id"]: r["vec_id"] for r in rows}
    for _ in range(20):
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    got = cover_tree.near_duplicates(df, block=block).where("vec_id IS NOT NULL").collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (links[i], root[i]) for i in root}


def test_near_duplicates_with_negative_ids(spark):
    rows = [(i, 1, [1.0, 0.001 * i, 0.0]) for i in (-1, 3, 5)]
    got = cover_tree.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (2, -1) for i in (-1, 3, 5)}


def test_scaled_copies_meet_in_every_cell():
    """Pivots of one direction: rounding must not keep a vector out of another's cell."""
    rng = np.random.default_rng(4)
    one = rng.normal(size=16)
    x = [(one * f).tolist() for f in rng.uniform(0.1, 10, 400)]
    rows = pd.DataFrame({"label": "0", "dim": 16, "rid": range(400), "copies": 1, "embedding": x})
    pivots = cover_tree.unit(x[:5])
    cells = pd.concat(cover_tree._route({("0", 16): pivots}, 0.98, [rows]))
    assert cells.groupby("rid")["cell"].nunique().eq(5).all()


@pytest.mark.parametrize("count", [1000, 8000, 64_000])
def test_routing_holds_a_bounded_matrix(count):
    """Peak memory beside 1k, 8k and 64k pivots; vectors of a cluster visit few cells, both ends of each link meet."""
    import tracemalloc
    rng = np.random.default_rng(6)
    centre = cover_tree.unit(rng.normal(size=(count, 24)))
    x = cover_tree.unit(centre[rng.integers(0, count, 400)] + 0.01 * rng.normal(size=(400, 24)))
    rows = pd.DataFrame({"label": "0", "dim": 24, "rid": range(400), "copies": 1, "embedding": x.tolist()})
    tracemalloc.start()
    cells = pd.concat(cover_tree._route({("0", 24): centre}, 0.98, [rows]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6
    home = cells[cells["home"]].set_index("rid")["cell"]
    visits = set(zip(cells["rid"], cells["cell"], strict=True))
    near = np.argwhere(np.triu(x @ x.T >= 0.98, 1))
    assert len(home) == 400 and all((a, home[b]) in visits and (b, home[a]) in visits for a, b in near.tolist())
    print(count, "pivots:", round(len(cells) / 400, 1), "cells a vector,", round(peak / 1e6), "MB")


def test_nearest_reaches_the_recall(spark):
    df = vectors(spark, 1500)
    rows = {r["vec_id"]: r["embedding"] for r in df.collect() if r["vec_id"] is not None and fine(r["embedding"]) and len(r["embedding"]) == 6}
    got = vamana.nearest(df, df.where("vec_id % 20 = 0")).toPandas()
    hits, total = 0, 0
    for q in [i for i in rows if i % 20 == 0]:
        want = sorted((-float(np.dot(rows[q], rows[i])), i) for i in rows if i != q)[:20]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and np.allclose(mine["score"], [np.dot(rows[q], rows[i]) for i in mine["vec_id"]])
        hits, total = hits + len({i for _, i in want} & set(mine["vec_id"])), total + 20
    assert hits / total >= 0.95


@pytest.mark.parametrize("length", [1.0, 1e5, 1e20, 1e200, 1e-200])
def test_nearest_beside_vectors_of_other_lengths(spark, length):
    """A long or short vector beside many of length 1; several shards."""
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(60, 16))
    x = centre[rng.integers(0, 60, 1500)] + 0.3 * rng.normal(size=(1500, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[[77, 700]] *= length
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    index = vamana.build_index(df, shard_bytes=60_000)
    assert index.count() >= 4
    got = vamana.search(index, df.where("vec_id % 20 = 0 OR vec_id = 77"), shard_bytes=5_000).toPandas()
    hits = total = 0
    for q, mine in got.groupby("query_id"):
        score = x @ x[q]
        want = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:20]
        mine = mine.sort_values("rank")
        assert len(mine) == 20 and np.allclose(mine["score"], score[mine["vec_id"]], rtol=1e-12)
        hits, total = hits + len(set(want) & set(mine["vec_id"])), total + 20
    assert total == 20 * 76 and hits / total >= 0.95


def test_nearest_with_products_beyond_doubles(spark):
    rows = [(1, [1e200, 1.0]), (2, [2e200, 0.0]), (3, [1.0, 1.0]), (4, [-1e200, 0.0]), (5, [5e-324, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = vamana.nearest(df, df.where("vec_id = 1")).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(2, math.inf), (3, 1e200), (5, 1e200 * 5e-324), (4, -math.inf)]


def test_nearest_finds_exact_copies(spark):
    """A third of the rows are copies, in groups of 200, 30 and 2; one id has several rows of a vector."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1000, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)  # a copy is the nearest of all
    same = np.repeat(np.arange(23), [200, 100] + [30] * 5 + [2] * 16)
    rows = dict(enumerate(np.concatenate([x, x[same]])[rng.permutation(1000 + len(same))].tolist()))
    repeated = [(40, rows[40])] * 2 + [(60, rows[60])] * 30
    df = spark.createDataFrame([*rows.items(), *repeated], "vec_id bigint, embedding array<double>")
    got = vamana.nearest(df, df.where("vec_id % 5 = 0")).toPandas()
    mine = {q: (g["vec_id"].tolist(), g["score"].tolist()) for q, g in got.sort_values("rank").groupby("query_id")}
    everything = [*rows.items(), *repeated]
    hits = total = 0
    for q in range(0, len(rows), 5):
        want = sorted((-float(np.round(np.dot(rows[q], v), 9)), i) for i, v in everything if i != q)[:20]
        ids, scores = mine[q]
        assert len(ids) == 20 and q not in ids and scores == sorted(scores, reverse=True)
        hits, total = hits + sum((Counter(i for _, i in want) & Counter(ids)).values()), total + 20
    assert hits / total >= 0.99


# --- similar documents -------------------------------------------------------------


def plain_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(rows):
    sets = [(i, plain_sets(t)) for i, t in rows]
    root = {i: i for i, _ in rows}
    near = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    for _ in range(30):
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    return root, {i: len(s) for i, s in sets}


@pytest.mark.parametrize("options", [{}, {"short": 1, "bucket": 50, "group_tokens": 100}])
def test_similar_documents_equal_all_pairs(spark, documents, options):
    for df in (documents, spark.read.parquet(f"{SF}/documents.parquet")):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").distinct().collect() if r["doc_id"] is not None]
        root, sizes = plain_components(rows)
        got = jaccard.similar_documents(df, **options).where("doc_id IS NOT NULL").collect()
        assert {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in got} == {(i, root[i], sizes[i]) for i in root}


def test_bytes_of_the_first_exchange_follow_the_postings():
    """One block, then three, into few and into sixty times as many buckets."""
    rng = np.random.default_rng(3)

    def scattered(docs, buckets):
        texts = [" ".join(f"w{x}" for x in rng.integers(0, 10 ** 6, 120)) for _ in range(docs)]
        frame = pd.DataFrame({"text": texts, "cls": np.arange(docs), "fam": np.arange(docs) % (docs // 2 + 1)})
        rows = pd.concat(jaccard._scatter(buckets, False, 75, 5, [frame]))
        postings = sum(len(x) // 8 for x in rows["token"])
        return sum(rows[c].map(len).sum() for c in ("token", "place", "doc", "fam")) / postings
    from pyspark import TaskContext
    given = TaskContext.get
    TaskContext.get = staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 0})())
    try:
        sizes = [scattered(docs, buckets) for docs, buckets in ((500, 10), (1500, 30), (4500, 90), (1500, 1800))]
    finally:
        TaskContext.get = given
    assert max(sizes) <= 20.5 and max(sizes[:3]) <= 1.5 * min(sizes[:3])


def test_postings_of_one_block():
    rng = np.random.default_rng(5)
    token, fam = rng.integers(0, 40, 400), rng.integers(0, 6, 400)
    fam[token < 10] = 3
    order = np.lexsort((fam, token))
    token, fam = token[order], fam[order]
    sent = jaccard._first_and_last(token, fam)
    for t in set(token.tolist()):
        mine = token == t
        assert set(fam[mine & sent]) == {fam[mine].min(), fam[mine].max()}
        assert sent[mine].sum() == (mine.sum() if len(set(fam[mine])) == 1 else 2)


def test_similar_documents_that_share_a_passage(spark):
    rng = np.random.default_rng(9)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(160):
        own = [f"w{x}" for x in rng.integers(0, 10**6, int(rng.integers(0, 22)))]
        at = int(rng.integers(0, len(own) + 1))
        rows.append((i, " ".join(own[:at] + passage + own[at:])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    root, sizes = plain_components(rows)
    assert 1 < len(set(root.values())) < len(rows)
    got = jaccard.similar_documents(df, bucket=300).collect()
    assert {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in got} == {(i, root[i], sizes[i]) for i in root}


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("(id * 7) % 301 AS a", "((id + 1) * 7) % 301 AS b").repartition(7)
    assert {r["component"] for r in components(edges).collect()} == {0}


# --- mixing ------------------------------------------------------------------------


def plain_mix(rows, weights, share, epochs):
    """Budgets by repeated redistribution, prefixes by sorting every leaf."""
    size = {r: -(-len(r[4] or "") // 4) for r in rows}

    def takes(r):
        return all(weights[level].get(r[1 + level], 1.0) > 0 for level in range(3))

    def spread(budget, level, members):
        if level == 3:
            return {members[0][:0] or tuple(members[0][1:4]): budget}
        groups = {}
        for r in members:
            groups.setdefault(r[1 + level], []).append(r)
        room = {g: epochs * sum(size[r] for r in m if takes(r)) for g, m in groups.items()}
        weight = {g: weights[level].get(g, 1.0) for g in groups}
        got, open_ = dict.fromkeys(groups, 0.0), {g for g in groups if weight[g] > 0}
        left = budget
        while open_:
            line = left / sum(weight[g] for g in open_)
            full = {g for g in open_ if room[g] <= line * weight[g]}
            if not full:
                got |= {g: line * weight[g] for g in open_}
                break
            got |= {g: room[g] for g in full}
            left -= sum(room[g] for g in full)
            open_ -= full
        return {leaf: b for g, m in groups.items() for leaf, b in spread(got[g], level + 1, m).items()}

    total, out = sum(size.values()), Counter()
    for leaf, budget in spread(total * share, 0, rows).items():
        mine = [r for r in rows if tuple(r[1:4]) == leaf]
        all_ = sum(size[r] for r in mine)
        whole = min(int(budget / all_ + 1e-9), epochs) if all_ else 0
        need, have = budget - whole * all_, 0
        order = sorted(mine, key=lambda r: hashlib.md5(f"{mixing.SEED}:{whole}:{r[0]}".encode()).hexdigest())
        for r in order:
            out[r[0]] += whole + (need > 1e-6 and have < need - 1e-6)
            have += size[r]
    return +out


@pytest.mark.parametrize("share", [0.1, 0.5, 1.7])
def test_mix_equals_plain_budgets(spark, share):
    rng = np.random.default_rng(2)
    rows = [(i, f"d{int(rng.integers(3))}", ["en", "de", None][int(rng.integers(3))], f"s{int(rng.integers(3)) if i % 3 else 0}", "w" * int(rng.integers(1, 400))) for i in range(300)]
    weights = {"domain": {"d0": 5.0, "d1": 1.0}, "lang": {"en": 3.0}, "source": {"s2": 0.0}}
    df = spark.createDataFrame(rows, "doc_id int, domain string, lang string, source string, text string")
    got = Counter(r["doc_id"] for r in mixing.mix(df, ["domain", "lang", "source"], weights, share=share, max_epochs=2).collect())
    assert got == plain_mix(rows, [weights["domain"], weights["lang"], weights["source"]], share, 2)


def test_room_of_weight_0_goes_to_the_siblings_of_the_parent(spark):
    """d0 has 100 tokens to give beside 900 of weight 0; its shortage belongs to d1, which has enough."""
    rows = [(f"{d}{s}{i}", d, s, "w" * 40) for d, s, n in (("d0", "a", 10), ("d0", "off", 90), ("d1", "a", 100)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id string, domain string, source string, text string")
    got = mixing.mix(df, ["domain", "source"], {"source": {"off": 0.0}}, budget=1000, max_epochs=1).groupBy("domain", "source").agg({"mix_tokens": "sum"}).collect()
    assert {tuple(r) for r in got} == {("d0", "a", 100), ("d1", "a", 900)}


def test_texts_without_tokens_come_along(spark):
    rows = [(1, "a", ""), (2, "a", None), (3, "b", "w" * 40), (4, "b", ""), (5, "off", "")]
    df = spark.createDataFrame(rows, "doc_id int, source string, text string")
    got = sorted((r["doc_id"], r["mix_epoch"]) for r in mixing.mix(df, ["source"], {"source": {"off": 0.0}}, share=1.0, max_epochs=3).collect())
    assert got == [(1, 0), (2, 0), (3, 0), (4, 0)]


def test_mix_on_odd_rows(documents):
    found = queries.mixed(documents)
    assert 0 < found.count() and set(documents.columns) < set(found.columns)


def test_mix_keeps_columns_of_any_name(spark):
    names = ["domain", "mix_tokens", "mix_epoch", "_key", "_l0", "_need", "_epochs", "_got", "level0", "tokens", "id", "doc", "a.b", "_d0"]
    rows = [(i, "w" * (40 + i), "s", "en", *[f"{n}{i}" for n in names]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string, lang string, " + ", ".join(f"`{n}` string" for n in names))
    found = queries.mixed(df)
    assert found.columns == [*df.columns, "mix_tokens_", "mix_epoch_"] and found.count() > 10
    assert all(r[n] == f"{n}{r['doc_id']}" for r in found.collect() for n in names)
    staged = corpus_pipeline.mix_sources(spark, df, SF)
    assert staged.columns == df.columns and {r["domain"] for r in staged.collect()} <= {f"domain{i}" for i in range(60)}


# --- samples -----------------------------------------------------------------------


def test_sample_depends_on_the_rows_alone(spark):
    rows = [(i % 400, f"text {i}", "ab"[i % 50 == 0]) for i in range(3000)] + [(None, "no id", "a")] * 900 + [(7, f"hot {i}", "a") for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, text string, lang string")
    for per in (None, "lang"):
        found = [sorted(map(str, frames.bounded_sample(df.repartition(n, F.rand(n)), 200, per).collect())) for n in (1, 3, 17)]
        assert found[0] == found[1] == found[2] and 150 <= len(found[0]) <= 200
        if per:
            assert sum("lang='b'" in r for r in found[0]) == 60
    assert frames.bounded_sample(df.limit(0), 200, "lang").count() == 0


def test_a_repeated_id_does_not_fill_the_training_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"copy {i}") for i in range(500)] + [(i, f"text {i}") for i in range(2, 30)], "doc_id int, text string")
    marks = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 30)] + [(1, 1)] * 50, "doc_id int, toxic int")
    sizes = []
    monkeypatch.setattr(toxicity, "fitted", lambda sample, fit: sizes.append(sample.count()))
    toxicity.train(docs, marks, sample=100, held_out=None)
    assert sizes == [29]


@pytest.mark.parametrize("gap", [20, 94, 95, 99, 100, 101, 120, 500, 3000])
def test_addresses_with_long_names(gap):
    long, four = "N" + "a" * (gap - 1), " ".join(["N" + "b" * (gap // 4)] * 4)
    for name in (long, four, f"{long} {long}"):
        text = f"Send it to 12 {name} Street, please. x12 {name} Road, a {name} Lane"
        assert ("address", 11, 11 + len(f"12 {name} Street")) in pii.spans(text)
        assert sum(k == "address" for k, *_ in pii.spans(text)) == 1
    assert not any(k == "address" for k, *_ in pii.spans("12 A B C D E Street, 123456 A Street, 1 a Street, 12  A Street"))
    assert ("address", 2, 19) in pii.spans("9 12b O'Neil Street")


# --- pipeline ----------------------------------------------------------------------


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == docs.columns
        if name == "near_copies":
            root, _ = plain_components([(r["doc_id"], r["text"]) for r in before.collect()])
            assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(root.values()))
        if name == "pii":
            assert not any(plain_spans(r["text"]) for r in after.collect()) and after.count() == before.count()
        before = after
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
