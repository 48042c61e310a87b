"""Documents that share most of their word shingles, by T-occurrence search.

Two sets link when their Jaccard similarity reaches the threshold.  A link
needs ``t = ceil(threshold * size)`` common shingles on either side, which the
steps below use as an overlap count over inverted lists:

1. Equal sets become one class.  Min-hashes put likely near copies into
   families; this only decides what is searched together, never what links.
2. Inverted lists of the shingles with the smallest hashes show which classes
   have enough shingles in common with other families; lists of whole sets
   then leave the classes with ``t`` such shingles.
3. Among those, short lists are merged and counted per class and family.  A
   class whose count reaches ``t`` less its shingles on long lists (DivideSkip)
   makes both families one search group.  Classes that consist of long lists
   alone are one more group, so nothing is left out.
4. Inside a group each class searches the others: heap-merged short lists give
   candidates, long lists are probed by binary search, the exact test follows.

All counts are taken over all documents.  Lists are dealt by shingle and sent
as packed arrays, one row per block of documents and bucket of shingles.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.components import Forest, components
from tickwell.llm.frames import as_ids, whole_numbers, written

WORDS = 5
THRESHOLD = 75  # percent
SKETCH = 24  # min-hashes a class
BAND = 3  # min-hashes that must agree for one family
BUCKET = 1_000_000  # postings of one task
BLOCK = 1_000_000  # shingles of one block of classes, about; a longer text is a block of its own
SHORT = 32  # families on a list that is still merged across families
GROUP_TOKENS = 16_384  # shingles of one block of a search group
SENT_BYTES = 48 << 20  # of a table of ids that is sent to all executors at once; a larger one is joined by shuffle
MIX = np.uint64(0x9E3779B97F4A7C15)


# --- sets --------------------------------------------------------------------------


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; empty without words."""
    import xxhash
    digest = xxhash.xxh3_64_intdigest
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(digest, found), np.uint64, len(found))
    size = min(words, len(h))
    count = len(h) - size + 1
    v = h[:count] * MIX + np.uint64(size)
    for k in range(1, size):
        v = (v ^ h[k:k + count]) * MIX
        v ^= v >> np.uint64(29)
    return np.unique(v)


def needed(size, threshold: int = THRESHOLD):
    """Least overlap that a linked set of this size has."""
    return -(-threshold * size // 100)


def links(common, a, b, threshold: int = THRESHOLD):
    return 100 * common >= threshold * (a + b - common)


def extra(size: int, threshold: int = THRESHOLD) -> int:
    """Common shingles that two linked sets must show among their smallest hashes."""
    return min(needed(size, threshold), max(8, size * 2 // 25))


def prefix(size: int, threshold: int = THRESHOLD) -> int:
    return min(size, size - needed(size, threshold) + extra(size, threshold))


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(1, 2**63, SKETCH, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, SKETCH, dtype=np.uint64)


def _sketch(words: int, batches):
    """(doc_id, n, cls, mins): set size, hash of the whole set, min-hashes."""
    import xxhash
    times, plus = _multipliers()
    for batch in batches:
        rows = []
        for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
            s = shingles(text, words)
            mins = None
            if len(s):
                mins = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
                for lo in range(0, len(s), 65_536):
                    x = s[None, lo:lo + 65_536] * times[:, None] + plus[:, None]
                    mins = np.minimum(mins, (x ^ (x >> np.uint64(32))).min(axis=1))
                mins = (mins >> np.uint64(32)).astype(np.int64).tolist()
            name = int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else None
            rows.append((doc, len(s), name, mins))
        yield pd.DataFrame({"doc_id": whole_numbers(as_ids(r[0] for r in rows)), "n": [r[1] for r in rows],
                            "cls": whole_numbers([r[2] for r in rows]), "mins": [r[3] for r in rows]})


# --- inverted lists in buckets -----------------------------------------------------


def _sets_of(batches, words: int):
    """Classes and their sets in blocks of about ``BLOCK`` shingles."""
    for batch in batches:
        packed = "tokens" in batch
        sets, size, first = [], 0, 0
        for i, value in enumerate(batch["tokens" if packed else "text"]):
            sets.append(np.frombuffer(value, np.uint64) if packed else shingles(value, words))
            size += len(sets[-1])
            if size >= BLOCK or i == len(batch) - 1:
                yield batch.iloc[first:i + 1][["cls", "fam"]].to_numpy(np.int64), sets
                sets, size, first = [], 0, i + 1


def _first_and_last(token: np.ndarray, fam: np.ndarray) -> np.ndarray:
    """Which postings of a block are sent, given in order of shingle and family.

    A shingle that two families of the block have is known to be shared: its
    first and last posting tell the other blocks so, the rest are counted here.
    A shingle that very many documents have then costs two postings a block.
    """
    if not len(token):
        return np.zeros(0, bool)
    starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    ends = np.r_[starts[1:], len(token)] - 1
    sent = np.repeat(fam[starts] == fam[ends], ends - starts + 1)
    sent[starts] = sent[ends] = True
    return sent


def _scatter(buckets: int, whole: bool, threshold: int, words: int, batches):
    """Packed postings of a block of classes: one row per bucket of shingles.

    A row carries the classes that occur in it, with their families, and for
    each posting the place of its class among them, so its bytes follow its
    postings.  The first row also names all classes of the block, with their
    sizes and the shared shingles that the block has counted itself.
    """
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    for number, (named, sets) in enumerate(_sets_of(batches, words)):
        by = np.argsort(named[:, 1], kind="stable")  # in order of families, and so are the postings of a shingle
        named, sets = named[by], [sets[i] for i in by]
        sizes = np.array([len(s) for s in sets], np.int64)
        if not whole:
            sets = [s[:prefix(len(s), threshold)] for s in sets]
        token = np.concatenate(sets)
        narrow = np.uint16 if len(sets) <= 65_535 else np.uint32
        doc = np.repeat(np.arange(len(sets), dtype=narrow), [len(s) for s in sets])
        sets.clear()
        order = np.argsort(token, kind="stable")
        token, doc = token[order], doc[order]
        sent = _first_and_last(token, named[doc, 1])
        known = np.bincount(doc[~sent], minlength=len(sizes)).astype(np.int64)
        token, doc = token[sent], doc[sent]
        bucket = ((token * MIX) >> np.uint64(33)) % np.uint64(buckets)
        order = np.argsort(bucket.astype(np.uint16) if buckets < 65_536 else bucket, kind="stable")
        token, doc, bucket = token[order], doc[order], bucket[order]
        head = named.tobytes() + sizes.tobytes() + known.tobytes()
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
        rows = []
        for i, (lo, hi) in enumerate(zip(starts, [*starts[1:], len(bucket)], strict=False)):
            there, place = np.unique(doc[lo:hi], return_inverse=True)
            rows.append((int(bucket[lo]), (part << 24) + number, head if i == 0 else b"", len(sizes), token[lo:hi].tobytes(), place.astype(narrow).tobytes(),
                         there.tobytes(), named[there, 1].tobytes()))
        yield pd.DataFrame(rows, columns=["bucket", "block", "head", "docs", "token", "place", "doc", "fam"])


SCATTERED = "bucket int, block long, head binary, docs int, token binary, place binary, doc binary, fam binary"


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Per block the number of shingles of each class that another family has too; packed as it came."""
    rows = rows.reset_index(drop=True)
    token = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["token"]])
    width = [np.uint16 if n <= 65_535 else np.uint32 for n in rows["docs"]]  # of the places and classes of a row
    present = [np.frombuffer(doc, kind) for doc, kind in zip(rows["doc"], width, strict=True)]
    ends = np.cumsum([len(p) for p in present])
    doc = np.concatenate([np.frombuffer(place, kind).astype(np.int64) + (end - len(p))
                          for place, kind, p, end in zip(rows["place"], width, present, ends, strict=True)])
    fam = np.concatenate([np.frombuffer(f, np.int64) for f in rows["fam"]])[doc]
    order = np.argsort(token)
    token, fam = token[order], fam[order]
    starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    several = np.minimum.reduceat(fam, starts) != np.maximum.reduceat(fam, starts)
    hits = np.bincount(doc[order][np.repeat(several, np.diff(np.r_[starts, len(token)]))], minlength=ends[-1])
    out = []
    for block, head, n, there, end in zip(rows["block"], rows["head"], rows["docs"], present, ends, strict=True):
        mine = hits[end - len(there):end]
        which = np.flatnonzero(mine)
        if len(which) or len(head):
            out.append((block, head, n, there[which].astype(np.uint32).tobytes(), mine[which].astype(np.uint32).tobytes()))
    return pd.DataFrame(out, columns=["block", "head", "docs", "doc", "hits"])


def _enough(whole: bool, threshold: int, rows: pd.DataFrame) -> pd.DataFrame:
    """The classes of a block that share enough shingles with other families."""
    n = int(rows["docs"].iloc[0])
    head = np.frombuffer(next(h for h in rows["head"] if len(h)), np.int64)
    pairs, sizes, hits = head[:2 * n].reshape(n, 2), head[2 * n:3 * n], head[3 * n:].copy()
    for doc, count in zip(rows["doc"], rows["hits"], strict=True):
        hits[np.frombuffer(doc, np.uint32)] += np.frombuffer(count, np.uint32)
    if whole:
        floor = needed(sizes, threshold)
    else:
        floor = np.array([extra(int(needed(int(s), threshold)), threshold) for s in sizes], np.int64)
    ok = (sizes > 0) & (hits >= floor)
    return pd.DataFrame({"cls": pairs[ok, 0], "fam": pairs[ok, 1], "n": sizes[ok]})


def _surviving(source: DataFrame, postings: int, whole: bool, threshold: int, words: int, bucket: int) -> DataFrame:
    buckets = max(1, math.ceil(postings / bucket))
    spread = source.mapInPandas(partial(_scatter, buckets, whole, threshold, words), SCATTERED)
    counted = spread.groupBy("bucket").applyInPandas(_shared, "block long, head binary, docs int, doc binary, hits binary")
    return written(counted.groupBy("block").applyInPandas(partial(_enough, whole, threshold), "cls long, fam long, n long"), "survivors")


def _candidates(short: int, rows: pd.DataFrame) -> pd.DataFrame:
    """(class, family, count) over short lists, and (class, null, count) over long ones."""
    token = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["tokens"]])
    sizes = [len(x) // 8 for x in rows["tokens"]]
    cls, fam = np.repeat(rows["cls"].to_numpy(np.int64), sizes), np.repeat(rows["fam"].to_numpy(np.int64), sizes)
    order = np.lexsort((fam, token))
    token, cls, fam = token[order], cls[order], fam[order]
    if not len(token):
        return pd.DataFrame({"cls": [], "other": [], "count": []})
    new_token = np.r_[True, token[1:] != token[:-1]]
    new_fam = new_token | np.r_[True, fam[1:] != fam[:-1]]
    lists = np.cumsum(new_token) - 1
    families = np.bincount(lists[new_fam])  # of each list
    names, first = fam[new_fam], np.cumsum(families) - families
    mine = families[lists]
    merged = (mine > 1) & (mine <= short)
    times = mine[merged]
    left = np.repeat(cls[merged], times)
    own = np.repeat(fam[merged], times)
    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    other = names[np.repeat(first[lists[merged]], times) + step]
    apart = other != own
    found = pd.DataFrame({"cls": left[apart], "other": other[apart]}).groupby(["cls", "other"]).size().reset_index(name="count")
    long = pd.DataFrame({"cls": cls[mine > short]}).groupby("cls").size().reset_index(name="count")
    missing = np.r_[np.zeros(len(found), bool), np.ones(len(long), bool)]
    other = pd.arrays.IntegerArray(np.r_[found["other"].to_numpy(np.int64), np.zeros(len(long), np.int64)], missing)
    return pd.concat([found[["cls", "count"]], long], ignore_index=True).assign(other=other)


def _deal(buckets: int, batches):
    """Whole sets cut into buckets of shingles, a row per class and bucket."""
    for batch in batches:
        rows = []
        for cls, fam, tokens in zip(batch["cls"], batch["fam"], batch["tokens"], strict=True):
            token = np.frombuffer(tokens, np.uint64)
            bucket = ((token * MIX) >> np.uint64(33)).astype(np.int64) % buckets
            for b in np.unique(bucket):
                rows.append((int(b), cls, fam, token[bucket == b].tobytes()))
        yield pd.DataFrame(rows, columns=["bucket", "cls", "fam", "tokens"])


# --- search inside a group ---------------------------------------------------------


class Index:
    """Inverted lists over the sets of one task."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.sizes = sets, np.array([len(s) for s in sets], np.int64)
        token = np.concatenate(sets)
        doc = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(token, kind="stable")
        token, self.doc = token[order], doc[order]
        self.first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        self.token = token[self.first]
        self.length = np.diff(np.r_[self.first, len(token)])

    def search(self, query: int, threshold: int) -> np.ndarray:
        """Documents linked with the query: DivideSkip over its inverted lists."""
        lists = np.searchsorted(self.token, self.sets[query])
        size = len(lists)
        t = int(needed(size, threshold))
        lists = lists[np.argsort(self.length[lists], kind="stable")]
        longest = int(self.length[lists[-1]])
        skipped = min(t - 1, int(t / (0.01 * math.log(longest + 1) + 1))) if longest > 8 else 0
        short, long = lists[:size - skipped], lists[size - skipped:]
        merged = np.sort(self._postings(short), kind="stable")  # the lists are sorted runs, which this sort merges
        first = np.flatnonzero(np.r_[True, merged[1:] != merged[:-1]][:len(merged)])
        met, count = merged[first], np.diff(np.r_[first, len(merged)])
        wide = (100 * self.sizes[met] >= threshold * size) & (100 * size >= threshold * self.sizes[met]) & (met != query)
        ok = wide & (count >= t - skipped)
        met, count = met[ok], count[ok]
        for number in long:
            if not len(met):
                break
            postings = self.doc[self.first[number]:self.first[number] + self.length[number]]
            at = np.minimum(np.searchsorted(postings, met), len(postings) - 1)
            count = count + (postings[at] == met)
        return met[links(count, size, self.sizes[met], threshold)]

    def _postings(self, lists: np.ndarray) -> np.ndarray:
        length = self.length[lists]
        where = np.repeat(self.first[lists], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        return self.doc[where]


def _link(threshold: int, rows: pd.DataFrame) -> pd.DataFrame:
    """Stars of the linked classes of one block or of two.

    A class that is already in the largest component need not search: its
    links inside that component change nothing, and the others search for it.
    """
    sets = [np.frombuffer(t, np.uint64) for t in rows["tokens"]]
    index, forest, size = Index(sets), Forest(), dict.fromkeys(range(len(sets)), 1)
    largest, open_ = 0, set(range(len(sets)))
    while open_:
        waiting = [d for d in sorted(open_) if forest.find(d) != forest.find(largest)]
        if not waiting and len(open_) < len(sets):
            break
        for d in waiting or [0]:
            if len(open_) < len(sets) and forest.find(d) == forest.find(largest):
                continue
            open_.discard(d)
            for other in index.search(d, threshold).tolist():
                a, b = forest.find(d), forest.find(other)
                if forest.union(a, b):
                    root = forest.find(a)
                    size[root] = size.pop(a) + size.pop(b) if a != b else size[root]
                    if size[root] > size.get(forest.find(largest), 0) or forest.find(largest) == root:
                        largest = root
    names = rows["rep"].to_numpy(np.int64)
    stars = forest.stars()
    return pd.DataFrame({"a": [names[x] for x, _ in stars], "b": [names[r] for _, r in stars]}, dtype="int64")


# --- the join ----------------------------------------------------------------------


def _families(reps: DataFrame) -> DataFrame:
    """(cls, fam, many): a family label by two steps along equal bands of min-hashes, and whether any band was shared."""
    bands = [F.xxhash64(F.lit(i), *[F.col("mins")[i + j] for j in range(BAND)]) for i in range(0, SKETCH, BAND)]
    banded = reps.select("cls", F.explode(F.array(*bands)).alias("band"))
    centers = banded.groupBy("band").agg(F.min("cls").alias("center"), F.count("*").alias("m")).where("m > 1")
    one = banded.join(centers, "band").groupBy("cls").agg(F.min("center").alias("fam"))
    one = written(one, "families")
    two = one.join(_small(one.where("cls <> fam").select(F.col("cls").alias("fam"), F.col("fam").alias("up"))), "fam", "left")
    return two.select("cls", F.coalesce("up", "fam").alias("fam"), F.lit(True).alias("many"))


def _small(ids: DataFrame) -> DataFrame:
    """A table of ids as a broadcast side while its bytes, a row's header and eight for each column, allow it."""
    return F.broadcast(ids) if ids.count() * (16 + 8 * len(ids.columns)) <= SENT_BYTES else ids


def _with_sets(words: int, batches):
    for batch in batches:
        tokens = [shingles(t, words).tobytes() for t in batch["text"]]
        yield batch[["cls", "rep", "fam", "cross"]].assign(n=[len(t) // 8 for t in tokens], tokens=tokens)


def _own_rows(words: int, batches):
    """Rows whose text has the set of the class they were joined with."""
    import xxhash
    for batch in batches:
        names = [int(np.uint64(xxhash.xxh3_64_intdigest(shingles(t, words).tobytes())).astype(np.int64)) for t in batch["text"]]
        yield batch[batch["cls"].to_numpy() == np.array(names, np.int64)]


def similar_documents(documents: DataFrame, threshold: int = THRESHOLD, words: int = WORDS, short: int = SHORT,
                      bucket: int = BUCKET, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id).

    Links follow ``100 * common >= threshold * union`` over sets of word
    shingles; fewer words than a shingle has are one shingle.  Null and empty
    texts have no shingles and stand alone.  Rows with a null id are counted
    but link with nothing.  Rows of one id are one document to the links, also
    when their texts differ.  An empty table gives an empty result.
    """
    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = written(plain.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(partial(_sketch, words), "doc_id long, n long, cls long, mins array<long>"), "sketches")
    reps = written(sketched.where("n > 0 AND doc_id IS NOT NULL").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("mins").alias("mins")), "classes")
    tokens = reps.agg(F.sum("n")).first()[0] or 0
    classes = written(reps.select("cls", "rep").join(_families(reps), "cls", "left").select(
        "cls", "rep", F.coalesce("fam", "cls").alias("fam"), F.coalesce("many", F.lit(False)).alias("many")), "members")
    ids = sketched.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1")
    repeated = ids.limit(1).count() > 0

    def texts(of: DataFrame) -> DataFrame:
        """One text of every class; where ids repeat, its set tells the rows of one id apart."""
        rows = plain.join(_small(of.withColumnRenamed("rep", "doc_id")), "doc_id")
        return rows.mapInPandas(partial(_own_rows, words), rows.schema).dropDuplicates(["cls"]) if repeated else rows

    first = _surviving(texts(classes.select("cls", "rep", "fam")), int(tokens * 0.36) + 1, False, threshold, words, bucket)
    crossing = _small(first.select("cls", F.lit(True).alias("cross")))
    wanted = written(classes.join(crossing, "cls", "left").where("cross OR many").select(
        "cls", "rep", "fam", F.coalesce("cross", F.lit(False)).alias("cross")), "wanted")
    sets = written(texts(wanted).withColumnRenamed("doc_id", "rep").mapInPandas(partial(_with_sets, words), "cls long, rep long, fam long, cross boolean, n long, tokens binary"), "sets")

    volume = first.agg(F.sum("n")).first()[0] or 0
    second = _surviving(sets.where("cross"), volume, True, threshold, words, bucket)
    volume = second.agg(F.sum("n")).first()[0] or 0
    dealt = sets.join(_small(second.select("cls")), "cls").mapInPandas(
        partial(_deal, max(1, math.ceil(4 * volume / bucket))), "bucket int, cls long, fam long, tokens binary")
    counted = written(dealt.groupBy("bucket").applyInPandas(partial(_candidates, short), "cls long, other long, count long").groupBy("cls", "other").agg(
        F.sum("count").alias("count")), "candidates")
    skipped = counted.where("other IS NULL").select("cls", F.col("count").alias("skipped"))
    least = F.ceil(F.col("n") * threshold / 100).cast("long") - F.coalesce("skipped", F.lit(0))
    judged = written(second.select("cls", "n").join(_small(skipped), "cls", "left").select("cls", least.alias("least")), "judged")
    crossed = counted.where("other IS NOT NULL").join(_small(judged), "cls").where("least >= 1 AND count >= least").select(
        F.col("cls").alias("a"), F.col("other").alias("b"))
    rest = judged.where("least < 1").select(F.col("cls").alias("a"))
    hub = rest.agg(F.min("a")).first()[0]
    edges = classes.where("many").select(F.col("cls").alias("a"), F.col("fam").alias("b")).unionByName(crossed)
    if hub is not None:
        edges = edges.unionByName(rest.withColumn("b", F.lit(hub)))
    groups = written(components(edges).select(F.col("node").alias("cls"), F.col("component").alias("grp")), "groups")

    members = sets.join(_small(groups), "cls")
    blocks = members.groupBy("grp").agg(F.count("*").alias("m"), F.ceil(F.sum("n") / group_tokens).cast("int").alias("want")).where("m > 1").select(
        "grp", F.least("want", F.col("m").cast("int")).alias("blocks"))
    placed = members.join(_small(written(blocks, "blocks")), "grp").withColumn("own", F.pmod(F.xxhash64("cls", F.lit(11)), F.col("blocks")).cast("int"))
    paired = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "grp", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "rep", "tokens")
    found = written(paired.groupBy("grp", "i", "j").applyInPandas(partial(_link, threshold), "a long, b long"), "links")
    joined = written(components(found), "joined")
    labels = classes.select("cls", "rep").join(_small(joined.withColumnRenamed("node", "rep")), "rep", "left").select(
        "cls", F.coalesce("component", "rep").alias("component_id"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return sketched.select("doc_id", "n", "cls").join(labels, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def first_of_each(documents: DataFrame) -> DataFrame:
    """The document with the smallest id of every component, with all its columns.

    Rows of one id are one document, of which one row stays; rows without an
    id all stay.
    """
    linked = similar_documents(documents).where("doc_id IS NOT NULL AND doc_id <> component_id").select("doc_id").distinct()
    kept = documents.join(_small(linked), "doc_id", "left_anti").select(*documents.columns)
    ids = documents.where("doc_id IS NOT NULL").groupBy("doc_id").count()
    if ids.where("count > 1").limit(1).count():
        kept = kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id IS NULL"))
    return kept
