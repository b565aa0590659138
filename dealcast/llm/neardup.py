"""Near-duplicate groups by bottom-k sketches from one hash function.

A document's set holds the hashes of its distinct shingles of ``size`` words
(words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a shorter text is one
shingle; a text without words has an empty set and is linked with nothing).
Two documents are linked if their sets have Jaccard similarity >= ``percent``
/ 100. Groups are the connected components of the links.

1. *Sketch.* The ``k`` smallest hashes of a set are its sketch. Documents with
   equal sets are one class, so exact copies cost one row, however many.
2. *Inverted lists.* Similar sets share at least ``need`` sketch values, so they
   share a value among each one's ``|sketch| - need + 1`` rarest ones (prefix
   principle; the order is by the number of classes that retain a value, then
   the value). Only these are posted. Sets that are wholly retained by both
   sketches have an exact bound; for larger ones the overlap of the sketches of a
   pair at the threshold is binomial(k, percent / 100), and ``need`` leaves a
   chance of about 1e-8 to fall below it.
3. *Pairs without all pairs.* First each list's members meet one pivot of the
   list. Lists whose members are then in one component are done. In short lists
   that are left, members of different components are paired (a posting carries
   the set size and a bitmap of its class's sketch, so pairs that can't be links
   are never formed). A long list that is left goes into the bucket of its main
   component, by powers of two of the set size, and buckets are compared block by
   block inside tasks: no link between different components is lost and no pairs
   of a large group are ever rows. If much is left, more pivots come before that.
   Postings are shuffled by value in portions of at most about ``PORTION`` rows.
4. *Estimate.* The k smallest values of the two sketches' union give the
   similarity; a pair goes on if as many of them are shared as ``need`` says. For
   this only sketches are moved, of a bucket with blocks of ``BLOCK`` documents.
5. *Exact.* Jaccard on the full sets decides every link; only texts of documents
   that have a partner by the estimate are moved for it.

Disk: a step's shuffle files go when it ends, and tables when nothing reads them.

Shingles are told apart by 64-bit hashes. Defined results: null text is empty
text; every row gives one row; a row with a null id takes part in no group
(component_id null, kept true); rows that repeat an id are one document, whose
groups are joined if their texts differ. An empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from dealcast.llm import common as C
from dealcast.llm.components import components

IDS_BROADCAST = 1_000_000   # rows of an id table that may be broadcast (16 MB)
GROUPS_BROADCAST = 100_000  # rows of a table of comparisons that may be broadcast
PIVOT_ROUNDS = 3
SHORT = 32                  # members of a list whose pairs may be formed
SIDE = 128                  # documents on each side of a comparison in a task
BLOCK = 1024                # the same for comparisons of sketches only
PORTION = 10_000_000        # postings, or pairs with a sketch, that are shuffled at once (1 to 4 GB)
EFFORT = 100                # comparisons a class that buckets may leave without further pivots
BITMAP = 8                  # 64-bit numbers of a class's bitmap
_BITS = [f"b{i}" for i in range(BITMAP)]
_ITEM = ["rep", "n", "least", *_BITS]


def needed_overlap(k: int, percent: int, risk: float = 2e-8) -> int:
    """The largest ``need`` that a pair at the threshold misses with at most
    ``risk``: P(binomial(k, percent / 100) < need) <= risk."""
    p, below, need = percent / 100, 0.0, 0
    while need < k:
        below += comb(k, need) * p ** need * (1 - p) ** (k - need)
        if below > risk:
            break
        need += 1
    return max(1, need)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = C.read_words(column, C.SPACED)
    counts = words.counts()
    h, first = C.shingle_hashes(words, size)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(words.doc[first], minlength=words.n_docs))])
    word_ends = np.cumsum(counts)
    out = []
    for d in range(words.n_docs):
        own = h[bounds[d]:bounds[d + 1]]
        if not len(own) and counts[d]:  # fewer words than a shingle: the whole sequence
            whole = np.uint64(counts[d])
            with np.errstate(over="ignore"):
                for x in words.hash[word_ends[d] - counts[d]:word_ends[d]]:
                    whole = C.mix(np.array([whole * np.uint64(31) + x], np.uint64))[0]
            own = np.array([whole], np.uint64)
        out.append(np.unique(own))
    return out


def sketches(docs: DataFrame, doc_id: str, text: str, size: int, k: int) -> DataFrame:
    """(doc_id, n, same, sketch, b0 to b7): set size, digest of the whole set,
    the k smallest hashes (as bytes) and a bitmap of them."""
    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in C.text_slices(batch, "text"):
                sets = shingle_sets(part.column(1), size)
                kept = [s[:k] for s in sets]
                owner = np.repeat(np.arange(len(sets)), [len(s) for s in kept])
                spot = C.mix(np.concatenate([*kept, np.zeros(0, np.uint64)])) % np.uint64(64 * BITMAP)
                bits = np.zeros((BITMAP, len(sets)), np.uint64)
                np.bitwise_or.at(bits, ((spot // np.uint64(64)).astype(int), owner), np.uint64(1) << (spot % np.uint64(64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in kept], pa.binary()), *[pa.array(x.view(np.int64)) for x in bits]],
                    names=["doc_id", "n", "same", "sketch", *_BITS])
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(rows, "doc_id long, n long, same binary, sketch binary, " + ", ".join(f"{b} long" for b in _BITS)))


def _values(classes: DataFrame) -> DataFrame:
    """(value, rep): sketch values by row."""
    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                sk = [np.frombuffer(b, np.int64) for b in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sk)), pa.array(np.repeat(part.column(0).to_numpy(), [len(s) for s in sk]))], names=["value", "rep"])
    return classes.select("rep", "sketch").mapInArrow(rows, "value long, rep long")


def _least(k: int, percent: int, need: int):
    """The overlap that the sketch of a set of size n has with any similar partner's."""
    # wholly retained on both sides: the partner has at most n * 100 / percent <= k shingles
    return F.when(F.col("n") * 100 <= k * percent, F.ceil(F.col("n") * percent / 100)).otherwise(F.least(F.col("n"), F.lit(k), F.lit(need))).cast("long")


def postings(classes: DataFrame, k: int, percent: int, need: int) -> DataFrame:
    """(value, rep, n, least, bitmap) of the posted values that two classes or
    more retain. ``least``: the overlap that any similar partner has."""
    values = _values(classes)
    seen = values.groupBy("value").agg(F.count(F.lit(1)).alias("seen")).where(F.col("seen") > 1)
    held = F.least(F.col("n"), F.lit(k))
    shared = values.join(seen, "value").join(classes.select("rep", "n", *_BITS).withColumn("least", _least(k, percent, need)), "rep")
    # a class's values that nobody else retains come first in the order and can match nothing
    by = Window.partitionBy("rep")
    nth = F.row_number().over(by.orderBy("seen", "value"))
    return (shared.withColumn("_nth", nth + held - F.count(F.lit(1)).over(by))
            .where(F.col("_nth") <= held - F.col("least") + 1).select("value", "rep", "n", "least", *_BITS))


def _possible(x: str, y: str, percent: int):
    """Whether sizes and common bits allow a link. Distinct values may share a
    bit; the allowance for that keeps the chance of a loss below 1e-9."""
    size = (F.col(f"{x}.n") * 100 >= F.col(f"{y}.n") * percent) & (F.col(f"{y}.n") * 100 >= F.col(f"{x}.n") * percent)
    common = sum((F.bit_count(F.col(f"{x}.{b}").bitwiseAND(F.col(f"{y}.{b}"))) for b in _BITS), F.lit(0))
    least = F.greatest(f"{x}.least", f"{y}.least")
    return size & (common >= F.floor(least * 0.75) - 4)


def _shared(left: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Number of values that each sorted set of ``others`` shares with ``left``."""
    values = np.concatenate(others)
    at = np.minimum(np.searchsorted(left, values), len(left) - 1)
    owner = np.repeat(np.arange(len(others)), [len(o) for o in others])
    return np.bincount(owner[left[at] == values], minlength=len(others))


def _shared_all(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """The same for each of ``rows`` with all sets, by matrix products over
    the values that several sets have."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    names, at, seen = np.unique(values, return_inverse=True, return_counts=True)
    number = np.cumsum(seen > 1) - 1
    kept = seen[at] > 1
    at, owner = number[at[kept]], owner[kept]
    out = np.zeros((len(rows), len(sets)), np.float32)
    for lo in range(0, int(number[-1]) + 1 if len(names) else 0, 4096):
        here = (at >= lo) & (at < lo + 4096)
        x = np.zeros((len(sets), 4096), np.float32)
        x[owner[here], at[here] - lo] = 1
        out += x[rows] @ x.T
    return out.astype(np.int64)


def _estimates(left: list[np.ndarray], others: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the k smallest values of each union of two sketches (``left`` with
    ``others``, by place): how many there are, and how many of them both have;
    and how many values both have at all."""
    top = np.uint64(2 ** 64 - 1)
    both = np.full((len(others), 2 * k), top, np.uint64)
    for at, side in ((0, left), (k, others)):
        held = np.array([len(x) for x in side], np.int64)
        row = np.repeat(np.arange(len(side)), held)
        both[row, at + np.arange(len(row)) - np.repeat(np.cumsum(held) - held, held)] = np.concatenate([*side, np.zeros(0, np.uint64)])
    both.sort(axis=1)
    again = np.zeros(both.shape, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != top)
    rank = np.cumsum(~again, axis=1)
    size = np.minimum(k, (~again & (both != top)).sum(1))
    return size, (again & (rank <= k)).sum(1), again.sum(1)


def _alike(left: list[np.ndarray], others: list[np.ndarray], n: np.ndarray, m: np.ndarray, k: int, percent: int, need: int) -> np.ndarray:
    """Whether the sketches of each pair allow a link; ``n`` and ``m`` are the
    sets' sizes. A sketch of fewer than k values is the whole set."""
    out = np.zeros(len(n), bool)
    for lo in range(0, len(n), 8192):
        here = slice(lo, lo + 8192)
        seen, both, all_both = _estimates(left[here], others[here], k)
        whole = (n[here] < k) & (m[here] < k)
        out[here] = np.where(whole, 100 * all_both >= percent * (n[here] + m[here] - all_both), both >= np.minimum(need, seen))
    return out & (n * 100 >= m * percent) & (m * 100 >= n * percent)


def _read_sketches(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _promising(k: int, percent: int, need: int, side: int):
    """Of one group of documents (two blocks, or one with itself) those that
    have a partner by their sketches, as groups of the same kind with at most
    ``side`` documents on each side."""
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        rep, comp, n = (group.column(c).to_numpy() for c in ("rep", "comp", "n"))
        minor, of = group.column("minor").to_numpy(), group.column("side").to_numpy()
        sketch = _read_sketches(group.column("sketch"))
        least = group.column("least").to_numpy()
        bits = np.stack([group.column(b).to_numpy().view(np.uint64) for b in _BITS], 1)
        found_a, found_b = [], []
        lefts = np.flatnonzero(minor)
        for lo in range(0, len(lefts), 64):
            left = lefts[lo:lo + 64]
            x, y = left[:, None], np.arange(len(rep))[None, :]
            # two minor ones meet once
            ok = (comp[x] != comp[y]) & (n[x] * 100 >= n[y] * percent) & (n[y] * 100 >= n[x] * percent)
            ok &= np.where(of[x] == 2, ~minor[y] | (y > x), (of[x] != of[y]) & (~minor[y] | (of[x] == 0)))
            i, j = np.nonzero(ok)
            i = left[i]
            common = np.zeros(len(i), np.int64)
            for b in range(BITMAP):
                common += np.bitwise_count(bits[i, b] & bits[j, b])
            ok = common >= np.floor(np.maximum(least[i], least[j]) * 0.75) - 4
            i, j = i[ok], j[ok]
            ok = _alike([sketch[p] for p in i.tolist()], [sketch[p] for p in j.tolist()], n[i], n[j], k, percent, need)
            found_a.append(i[ok])
            found_b.append(j[ok])
        a, b = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (found_a, found_b))
        swap = np.where(of[a] == 2, a > b, of[a] == 1)
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        # places within a side are cut into pieces: each pair of pieces with a find is a group
        place = np.zeros(len(rep), np.int64)
        for s in (0, 1, 2):
            place[of == s] = np.arange((of == s).sum()) // side
        name = group.column("g")[0].as_py()
        pieces = len(rep) // side + 1
        where = place[a] * pieces + place[b]
        out = []
        for key in np.unique(where).tolist():
            p, q = divmod(key, pieces)
            here = where == key
            alone = bool(p == q and of[a[here][0]] == 2)
            for at, docs in ((2, np.union1d(a[here], b[here])),) if alone else ((0, np.unique(a[here])), (1, np.unique(b[here]))):
                out.append(pa.table([pa.array([f"{name}/{p}/{q}"] * len(docs), pa.string()), pa.array(rep[docs]), pa.array(comp[docs]), pa.array(minor[docs]),
                                     pa.array(np.full(len(docs), at, np.int32))], names=["g", "rep", "comp", "minor", "side"]))
        return pa.concat_tables(out) if out else group.select(["g", "rep", "comp", "minor", "side"]).slice(0, 0)
    return run


def _compare(size: int, k: int, percent: int, need: int):
    """The links of one group of documents: each ``minor`` one with those of the
    other side (side 2: with all) outside its component. Links that earlier ones
    of the group imply are left out."""
    def run(group: pa.Table) -> pa.Table:
        rep = group.column("rep").to_numpy()
        comp = group.column("comp").to_numpy()
        minor, side = group.column("minor").to_numpy(), group.column("side").to_numpy()
        sets = []
        for batch in group.select(["text"]).combine_chunks().to_batches():
            for part in C.text_slices(batch, "text"):
                sets += shingle_sets(part.column(0), size)
        n = np.array([len(s) for s in sets], np.int64)
        sketch = [s[:k] for s in sets]
        lefts = np.flatnonzero(minor & (n > 0))
        exact = _shared_all(sets, lefts) if len(lefts) > 8 else None
        names, comp = np.unique(comp, return_inverse=True)
        links_a, links_b = [], []
        for p, i in enumerate(lefts.tolist()):
            ok = (comp != comp[i]) & (n * 100 >= n[i] * percent) & (n * percent <= n[i] * 100) & (n > 0)
            # two minor ones meet once
            ok &= ((side == 2) & (~minor | (np.arange(len(n)) > i))) if side[i] == 2 else (side != side[i]) & (~minor | (side[i] == 0))
            others = np.flatnonzero(ok)
            if not len(others):
                continue
            others = others[_alike([sketch[i]] * len(others), [sketch[j] for j in others], np.full(len(others), n[i]), n[others], k, percent, need)]
            if not len(others):
                continue
            same = exact[p, others] if exact is not None else _shared(sets[i], [sets[j] for j in others])
            for j in others[100 * same >= percent * (n[i] + n[others] - same)].tolist():
                if comp[j] != comp[i]:
                    links_a.append(rep[i])
                    links_b.append(rep[j])
                    comp[comp == comp[j]] = comp[i]
        return pa.table([pa.array(links_a, pa.int64()), pa.array(links_b, pa.int64())], names=["a", "b"])
    return run


def bucket_groups(members: DataFrame, side: int = SIDE) -> DataFrame:
    """Groups (g, rep, comp, minor, side) of the written ``members`` (bucket, rep,
    comp, minor): each bucket is cut into blocks of about ``side`` members, and
    each block with a minor member meets every block of its bucket. A member of
    a block without one is only sent to those that have some, so the rows grow
    with members times blocks with minor ones."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / side).cast("int").alias("cuts"))
    placed = members.join(C.broadcast_if_small(C.materialize(sizes), IDS_BROADCAST), "bucket").withColumn("i", F.pmod(F.xxhash64("rep"), F.col("cuts")).cast("int"))
    marked = C.materialize(placed.where("minor").select("bucket", F.col("i").alias("j")).distinct())
    marked = C.broadcast_if_small(marked, IDS_BROADCAST)
    of_marked = placed.join(marked.select("bucket", F.col("j").alias("i")), ["bucket", "i"], "left_semi").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    of_others = placed.join(marked.select("bucket", F.col("j").alias("i")), ["bucket", "i"], "left_anti").join(marked, "bucket")
    each = of_marked.unionByName(of_others)
    low, high = F.least("i", "j"), F.greatest("i", "j")
    return each.select(F.concat_ws("/", F.lit("b"), "bucket", low, high).alias("g"), "rep", "comp", "minor",
                       F.when(F.col("i") == F.col("j"), 2).when(F.col("i") < F.col("j"), 0).otherwise(1).alias("side"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80,
                    k: int = 48) -> DataFrame:
    """For each row of ``docs``: doc_id, n_shingles, component_id (the smallest
    id reachable over links, its own included) and kept (it is that id)."""
    with C.shuffles_dropped(docs.sparkSession):
        return _near_duplicates(docs, doc_id, text, size, percent, k)


def portions(column: str, rows: int, most: int) -> list:
    """Conditions on ``column`` that part ``rows`` rows into portions of about ``most``."""
    n = max(1, -(-rows // most))
    return [F.pmod(F.xxhash64(column), F.lit(n)) == i for i in range(n)] if n > 1 else [F.lit(True)]


def _near_duplicates(docs: DataFrame, doc_id: str, text: str, size: int, percent: int, k: int) -> DataFrame:
    spark = docs.sparkSession
    need = needed_overlap(k, percent)
    whole = C.materialize(sketches(docs, doc_id, text, size, k))
    classes = C.materialize(whole.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("same")
                            .agg(F.min(F.struct("doc_id", "n", "sketch", *_BITS)).alias("m"))
                            .select("same", F.col("m.doc_id").alias("rep"), *[F.col(f"m.{c}").alias(c) for c in ("n", "sketch", *_BITS)]))
    read = C.materialize(whole.select("doc_id", "n", "same"))
    C.release(spark, whole)
    lists = C.materialize(postings(classes, k, percent, need))
    many = classes.count()
    by_value = portions("value", lists.count(), PORTION)
    repeated = not read.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").isEmpty()
    texts = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("text")).where(F.col("rep").isNotNull())

    def in_portions(rows, conditions: list) -> DataFrame:
        """The rows that ``rows`` gives for each of the conditions, written one after the other."""
        parts = [C.materialize(rows(c)) for c in conditions]
        return functools.reduce(DataFrame.unionAll, parts)

    def confirmed(groups: DataFrame) -> DataFrame:
        """Links of ``groups`` (g, rep, comp, minor, side). Of the documents only
        those in a group are read out."""
        groups = C.materialize(groups)
        if groups.limit(GROUPS_BROADCAST + 1).count() <= GROUPS_BROADCAST:
            met = texts.join(F.broadcast(groups), "rep")
        else:
            asked = C.materialize(groups.select("rep").distinct())
            met = groups.join(texts.join(C.broadcast_if_small(asked, IDS_BROADCAST), "rep", "left_semi"), "rep")
        if repeated:
            met = met.dropDuplicates()
        found = met.select("g", "rep", "comp", "minor", "side", "text").groupBy("g").applyInArrow(_compare(size, k, percent, need), "a long, b long")
        return C.materialize(found)

    def of_asked(rows: DataFrame, *columns: str) -> DataFrame:
        """The classes that the written ``rows`` name, all of them if those are many."""
        asked = C.materialize(functools.reduce(DataFrame.unionAll, [rows.select(F.col(c).alias("rep")) for c in columns]).distinct())
        small = asked.limit(IDS_BROADCAST + 1).count() <= IDS_BROADCAST
        return classes.join(F.broadcast(asked), "rep", "left_semi") if small else classes

    def alike(pairs: DataFrame) -> DataFrame:
        """Those of the written ``pairs`` (a, b, comp_a, comp_b) that may be links by their sketches."""
        @C.task
        def rows(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                left, others = _read_sketches(batch.column(4)), _read_sketches(batch.column(6))
                yield batch.select([0, 1, 2, 3]).filter(pa.array(_alike(left, others, batch.column(5).to_numpy(), batch.column(7).to_numpy(), k, percent, need)))

        held = of_asked(pairs, "a", "b")

        def of(condition) -> DataFrame:
            met = (pairs.where(condition).join(held.select(F.col("rep").alias("a"), F.col("sketch").alias("x"), F.col("n").alias("nx")), "a")
                   .join(held.select(F.col("rep").alias("b"), F.col("sketch").alias("y"), F.col("n").alias("ny")), "b"))
            return met.select("a", "b", "comp_a", "comp_b", "x", "nx", "y", "ny").mapInArrow(rows, "a long, b long, comp_a long, comp_b long")
        return in_portions(of, portions("a", pairs.count(), PORTION))

    def by_pivot(pairs) -> DataFrame:
        """Groups of the pairs (a, b, comp_a, comp_b) that ``pairs`` gives for a
        portion of the lists: a document and up to about ``SIDE`` others."""
        pairs = alike(C.materialize(in_portions(lambda c: pairs(c).distinct(), by_value).distinct()))
        most = pairs.groupBy("a").count().agg(F.max("count").alias("most")).first().most or 0
        cut = F.pmod(F.xxhash64("b"), F.lit(max(1, -(-most // SIDE))))
        keyed = pairs.withColumn("g", F.concat_ws("/", F.lit("p"), "a", cut))
        own = keyed.select("g", F.col("a").alias("rep"), F.col("comp_a").alias("comp"), F.lit(True).alias("minor"), F.lit(0).alias("side")).distinct()
        return own.union(keyed.select("g", "b", "comp_b", F.lit(False), F.lit(1)))

    def of_buckets(members: DataFrame) -> DataFrame:
        """Groups of the buckets' members that have a partner by their sketches."""
        groups = C.materialize(bucket_groups(members, BLOCK))
        held = of_asked(groups, "rep").withColumn("least", _least(k, percent, need))
        return (groups.join(held, "rep").groupBy("g")
                .applyInArrow(_promising(k, percent, need, SIDE), "g string, rep long, comp long, minor boolean, side int"))

    def told(condition, *columns: str) -> DataFrame:
        """Postings with their components, of the lists that may hold several."""
        rows = lists.where(condition).select("value", "rep", *columns)
        if labels is None:
            return rows.withColumn("comp", F.col("rep"))
        return rows.join(C.broadcast_if_small(labels, IDS_BROADCAST), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))

    def mixed(condition) -> DataFrame:
        rows = told(condition, *_ITEM[1:])
        return rows if state is None else rows.join(state.where(condition), "value")

    links, labels, state = None, None, None
    item = F.struct("comp", *_ITEM)
    for turn in range(PIVOT_ROUNDS):
        order = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))

        def with_pivots(condition) -> DataFrame:
            here = mixed(condition)
            tops = here.groupBy("value").agg(F.count(F.lit(1)).alias("of"), F.min_by(item, order).alias("y")).where("of > 1")
            return (here.select("value", item.alias("x")).join(tops, "value")
                    .where((F.col("x.comp") != F.col("y.comp")) & _possible("x", "y", percent))
                    .select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b"), F.col("y.comp").alias("comp_a"), F.col("x.comp").alias("comp_b")))

        new = confirmed(by_pivot(with_pivots))
        links = new if links is None else links.union(new)
        labels = components(links)

        # the lists that are still of several components; any component may be a list's main one, the largest saves work
        def left_over(condition) -> DataFrame:
            own = told(condition).groupBy("value", "comp").agg(F.count(F.lit(1)).alias("n"))
            return (own.groupBy("value").agg(F.sum("n").alias("members"), F.max(F.struct("n", "comp"))["comp"].alias("main"),
                                             F.count(F.lit(1)).alias("comps")).where("comps > 1"))
        state = in_portions(left_over, by_value)

        # a partner's set size lies in one of the powers of two that a member is in
        def of_long(condition) -> DataFrame:
            long = told(condition, "n").join(state.where(condition).where(F.col("members") > SHORT), "value")
            bands = F.sequence(F.length(F.bin("n")), F.length(F.bin(F.floor(F.col("n") * 100 / percent))))
            return (long.groupBy("main", "rep", "comp", "n").agg(F.max(F.col("comp") != F.col("main")).alias("minor"))
                    .withColumn("band", F.explode(bands)).select(F.concat_ws("/", "main", "band").alias("bucket"), "rep", "comp", "minor"))
        members = in_portions(of_long, by_value)
        if len(by_value) > 1:
            members = C.materialize(members.groupBy("bucket", "rep", "comp").agg(F.max("minor").alias("minor")))
        work = members.groupBy("bucket").agg((F.sum(F.col("minor").cast("double")) * F.count(F.lit(1))).alias("w")).agg(F.sum("w").alias("w")).first().w
        if (work or 0) <= EFFORT * many:
            break

    def in_short(condition) -> DataFrame:
        short = mixed(condition).where(F.col("members") <= SHORT).select("value", "main", item.alias("x"))
        return (short.join(short.where("x.comp <> main").select("value", F.col("x").alias("y")), "value")
                .where((F.col("x.comp") != F.col("y.comp")) & ((F.col("x.comp") == F.col("main")) | (F.col("x.rep") > F.col("y.rep")))
                       & _possible("x", "y", percent))
                .select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b"), F.col("y.comp").alias("comp_a"), F.col("x.comp").alias("comp_b")))
    new = confirmed(by_pivot(in_short).union(of_buckets(members)))
    links = links.union(new)
    if repeated:  # rows with one id are one document: their groups are one
        own = read.where(F.col("doc_id").isNotNull()).select("doc_id", "same").join(classes.select("same", "rep"), "same").select("doc_id", "rep")
        first = own.groupBy("doc_id").agg(F.min("rep").alias("a"))
        links = links.union(own.join(first, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct())
    elif new.isEmpty():
        links = None
    labels = labels if links is None else components(links)
    of_class = (classes.select("same", "rep").join(C.broadcast_if_small(labels, IDS_BROADCAST), "rep", "left")
                .select("same", F.coalesce("comp", "rep").alias("comp")))
    found = read.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("same")).alias("same")).join(of_class, "same", "left")
    component = F.when(F.col("same").isNull(), F.col("doc_id")).otherwise(F.col("comp"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
