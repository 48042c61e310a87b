"""The prefix trie against a plain version and against SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest

from tickwell.llm import prefix_trie, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "turn bigint, text string, conv_id bigint, role string, depth int, hi string"


def rebuilt(rows):
    """Rows (turn, text, conv, role); equal turns differ in role at most."""
    convs = {}
    for turn, text, conv, role, *_ in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        saved[path] = own + sum(saved[k] for k in children.get(path, []))
        leaves[path] = sum(leaves[k] for k in children.get(path, [])) or 1
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def sample():
    rng = random.Random(11)
    rows = []
    for c in range(60):
        conv = c * 1_000_000_007 % 977 if c % 3 else c
        for t in range(rng.randrange(1, 14)):
            rows.append((t if rng.random() > 0.1 else t * 2, rng.choice(["a", "bé", "", None]), conv, rng.choice(["u", None]), 3, "x"))
    rows += [(t, f"word {t % 3}", 400, "u", 1, "x") for t in range(70)] + [(t, f"word {t % 3}", 401, "u", 1, "x") for t in range(90)]
    rows += [(t, f"word {t % 3}", 405, "u", 1, "x") for t in range(75)]
    rows += [(None, "first of all", 0, "u", 0, ""), (0, "no conversation", None, "u", 0, ""), (1, "x" * 200_000, -7, "u", 0, "")]
    rows += [(t, "copy", 500 + 5 * k, "u", 0, "") for k in range(40) for t in range(12)]
    seen, out = set(), []
    for r in rows:  # rows of one turn and role would have no order
        if (r[2], r[0], r[3] or "") not in seen:
            seen.add((r[2], r[0], r[3] or ""))
            out.append(r)
    return out


@pytest.mark.parametrize("bits", [1, 2, 6])
def test_trie_equals_the_plain_version(spark, bits):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(prefix_trie.conversation_trie(df, bits)) == plain_trie(rows)


def test_repeated_rows_are_turns_each(spark):
    rows = [(1, "again", 3, "u", 0, "")] * 150 + [(2, "end", 3, "u", 0, ""), (1, "again", 8, "u", 0, ""), (None, None, 9, None, None, None)]
    assert got(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(4))) == plain_trie(rows)


def test_empty_table_and_rows_without_conversation(spark):
    assert got(prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA))) == []
    assert got(prefix_trie.conversation_trie(spark.createDataFrame([(1, "a", None, "u", 0, "")], SCHEMA))) == []


def test_many_ends_of_one_node_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_BITS", 2)
    rows = [(1, "same", 5 * k, "u", 0, "") for k in range(-30, 90)]
    assert got(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain_trie(rows)


def test_whole_table_equals_sql_and_the_plain_version(spark):
    found = got(queries.op12_conversation_trie(spark, SF))
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("turn", "text", "conv_id", "role").collect()
    assert found == plain_trie([tuple(r) for r in rows])
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert found == sorted(con.sql(prefix_trie.oracle_sql()).fetchall(), key=lambda r: r[:2])


def test_cuts_do_not_depend_on_what_follows():
    elements = [bytes([i]) * 16 for i in range(50)]
    whole = []
    prefix_trie.cut(prefix_trie.ROOT, elements, whole)
    for n in range(1, 50):
        part = []
        prefix_trie.cut(prefix_trie.ROOT, elements[:n], part)
        assert part == whole[:n]
    assert len(set(whole)) == 50
