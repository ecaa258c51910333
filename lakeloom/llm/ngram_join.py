"""N-gram Jaccard self-join with token-combination prefixes.

A document's set holds its distinct ``size``-word shingles as 64-bit hashes.
Two documents link when ``100 * |both| >= percent * |either|``. Exact, in
these steps (n: set size, e = n - ceil(t n): tokens that a partner may lack):

1. Equal sets form a class; one document stands for it from here on.
2. Extended prefix: the first ``e + k`` tokens in hash order of linked sets
   share at least k tokens. Only these travel. Sets in which fewer than k of
   them occur in another set are done; shared boilerplate does not reach k.
3. The sets that are left are ordered by document frequency, rare tokens
   first. Tokens that no other set has cannot meet and are left out of the
   index. If the first shared token of two sets is rare, it lies in both plain
   prefixes (``e + 1`` tokens): rare tokens are indexed one by one. Else all
   their shared tokens are frequent. At most ``b = floor(3n/17)`` (for 85 %)
   tokens of the two sets are not shared, and each can part only one pair of
   shared neighbours: of the first ``b + 2`` shared tokens, two are adjacent
   frequent tokens in both sets. So for the frequent class pairs of adjacent
   tokens of the prefix of ``e + b + 2`` tokens are indexed.
4. Small buckets give candidate pairs, which are verified on whole sets.
   Large buckets are joined to families; of a family, one pivot is compared
   with every member, then members that are not linked to the pivot are
   compared with all members, in blocks of bounded size. Members linked to the
   pivot are in one component already, so nothing is lost, and no pair is
   emitted but links of a spanning forest of each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import _text
from lakeloom.llm._io import bounded, join_by_weight, staged, text_batches, unused
from lakeloom.llm.components import components

SIZE = 4
PERCENT = 85
#: buckets of more sets are handled as families; also where tokens are frequent
LARGE = 24
BLOCK = 128


def _token_sets(data, offsets, size):
    """Sorted distinct shingle hashes of a slice: flat tokens, count per row."""
    starts, ends, row = _text.words(data, offsets, _text.NON_SPACE)
    h = _text.word_hashes(data, starts, ends, folded=True)
    n_words = np.diff(row)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    w = _text.window_hashes(h, size)
    keep = doc[:len(w)] == doc[size - 1:] if len(w) else np.zeros(0, bool)
    tokens, owner = [w[keep]], [doc[:len(w)][keep]]
    for n in range(1, size):  # shorter texts: the whole sequence
        short = np.flatnonzero(n_words == n)
        if len(short):
            tokens.append(np.array([_text.window_hashes(h[row[i]:row[i] + n], n)[0] for i in short], np.uint64))
            owner.append(short)
    token, owner = np.concatenate(tokens), np.concatenate(owner)
    order = np.lexsort((token, owner))
    token, owner = token[order], owner[order]
    new = np.r_[True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])] if len(token) else np.zeros(0, bool)
    return token[new], owner[new], np.bincount(owner[new], minlength=len(n_words))


def _lack(n: np.ndarray, percent: int) -> np.ndarray:
    """How many tokens of a set of n a linked set may lack."""
    return n - -(-percent * n // 100)


def _shared_floor(n: np.ndarray) -> np.ndarray:
    """k of step 2: grows with n, 1 at least and never above what is shared."""
    return np.maximum(1, n // 20)


def _fingerprints(token: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums of mixed tokens for each row's set."""
    begin = np.minimum(np.cumsum(n) - n, len(token))
    return [_text.signed(np.add.reduceat(np.r_[x, np.uint64(0)], begin) * (n > 0).astype(np.uint64)) if len(n) else np.zeros(0, np.int64)
            for x in (_text.mix(token * np.uint64(0x9FB21C651E98DF25) + np.uint64(1)), _text.mix(token ^ np.uint64(0xA24BAED4963EE407)))]


def token_sets(docs: DataFrame, size: int, doc_id: str, text: str, percent: int | None = None) -> DataFrame:
    """(doc_id, n, f1, f2, tokens): set size, a 128-bit fingerprint of the set
    and its tokens, sorted; with ``percent`` only the extended prefix of them."""
    def run(batches):
        for batch in batches:
            for first, data, offsets in _text.slices(batch.column(1)):
                token, owner, n = _token_sets(data, offsets, size)
                f1, f2 = _fingerprints(token, n)
                sent = n
                if percent is not None:
                    sent = np.minimum(n, _lack(n, percent) + _shared_floor(n))
                    token = token[np.arange(len(token)) - (np.cumsum(n) - n)[owner] < sent[owner]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(n)), pa.array(n.astype(np.int64)), pa.array(f1), pa.array(f2),
                     _text.lists(_text.signed(token), sent)], ["doc_id", "n", "f1", "f2", "tokens"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null").mapInArrow(
        run, "doc_id long, n long, f1 long, f2 long, tokens array<long>")


def _with_frequency(rows: DataFrame) -> DataFrame:
    """Adds df >= 2 to (doc_id, token) rows; tokens of one set only go.
    Counting is partial in each task; a frequent token's rows can be split."""
    df = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df >= 2")
    return rows.join(df, "token")


def _survivors(sketch: DataFrame, percent: int) -> DataFrame:
    """Representatives with enough shared tokens in the extended prefix."""
    rows = sketch.select("doc_id", F.explode("tokens").alias("token"))
    shared = _with_frequency(rows).groupBy("doc_id").agg(F.count(F.lit(1)).alias("shared"))
    # A partner has percent of n tokens at least; k of the smaller one counts.
    least = F.greatest(F.lit(1), F.expr(f"(({percent} * n + 99) div 100) div 20"))
    return sketch.select("doc_id", "f1", "f2", "n").join(shared, "doc_id").where(F.col("shared") >= least).select("doc_id", "f1", "f2")


def _signatures(rows: DataFrame, percent: int, large: int) -> DataFrame:
    """(sig, doc_id, n) of sets given as (doc_id, n, unique, t: (df, token)
    of the shared tokens): single rare tokens, pairs of frequent neighbours."""
    def run(batches):
        for batch in batches:
            sig, ids, sizes = [], [], []
            for d, n, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                df = np.asarray(pairs.values.field("df"))
                token = np.asarray(pairs.values.field("token")).view(np.uint64)
                frequent = df > large
                # one order for all sets: rare before frequent, then by token
                order = np.lexsort((token, frequent))
                token, frequent = token[order], frequent[order]
                alone = n - len(token)  # tokens of this set only come first
                lack = int(_lack(np.int64(n), percent))
                apart = (100 - percent) * n // percent
                rare = token[:max(0, lack + 1 - alone)][~frequent[:max(0, lack + 1 - alone)]]
                often = token[:max(0, lack + apart + 2 - alone)][frequent[:max(0, lack + apart + 2 - alone)]]
                both = _text.window_hashes(often, 2)
                found = np.r_[_text.mix(rare), both]
                sig.append(_text.signed(found))
                ids.append(np.full(len(found), d))
                sizes.append(np.full(len(found), n))
            if sig:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (sig, ids, sizes)], ["sig", "doc_id", "n"])

    return rows.select("doc_id", "n", "t").mapInArrow(run, "sig long, doc_id long, n long")


def _verified_pairs(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (src, dst) among sets that share a small bucket."""
    a = entries.select("sig", F.col("doc_id").alias("src"), F.col("n").alias("n1"))
    b = entries.select("sig", F.col("doc_id").alias("dst"), F.col("n").alias("n2"))
    fits = (F.col("src") < F.col("dst")) & (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2"))
    pairs = a.join(b, "sig").where(fits).select("src", "dst").distinct()
    pairs = (pairs.join(sets.select(F.col("doc_id").alias("src"), F.col("tokens").alias("x")), "src")
             .join(sets.select(F.col("doc_id").alias("dst"), F.col("tokens").alias("y")), "dst"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("src", "dst")


def _overlaps(a: list[np.ndarray], b: list[np.ndarray], cells: int = 1 << 22) -> np.ndarray:
    """Sizes of all intersections of two short lists of sorted sets, by
    products of 0/1 tables of at most about ``cells`` cells."""
    out = np.zeros((len(a), len(b)), np.int64)
    step = max(1, cells // (max(map(len, a)) * len(a) + 1))
    for k in range(0, len(a), step):
        part = a[k:k + step]
        left = np.concatenate(part)
        names = np.unique(left)
        x = np.zeros((len(part), len(names)), np.float32)
        x[np.repeat(np.arange(len(part)), [len(s) for s in part]), np.searchsorted(names, left)] = 1
        wide = max(1, cells // len(names))
        for m in range(0, len(b), wide):
            other = b[m:m + wide]
            right = np.concatenate(other)
            owner = np.repeat(np.arange(len(other)), [len(s) for s in other])
            at = np.minimum(np.searchsorted(names, right), len(names) - 1)
            known = names[at] == right
            y = np.zeros((len(other), len(names)), np.float32)
            y[owner[known], at[known]] = 1
            out[k:k + step, m:m + wide] = x @ y.T
    return out


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> list[int]:
    """Indexes of links that join something new."""
    up, out = list(range(n)), []

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for k, (p, q) in enumerate(zip(i.tolist(), j.tolist())):
        p, q = root(p), root(q)
        if p != q:
            up[p] = q
            out.append(k)
    return out


def _family_links(entries: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links (src, dst) that join the linked members of large buckets."""
    spark = entries.sparkSession
    none = spark.createDataFrame([], "src long, dst long")
    roots = staged(entries.groupBy("sig").agg(F.min("doc_id").alias("dst"), F.count(F.lit(1)).alias("weight")), "roots")
    weighted = join_by_weight(entries, roots, "sig", "weight")
    family = components(weighted.select(F.col("doc_id").alias("src"), "dst"))
    if family is None:
        return none
    # The pivot has the most, and the most common, signatures of its family.
    weight = weighted.groupBy("doc_id").agg(F.sum("weight").alias("weight"))
    family = staged(family.select(F.col("node").alias("doc_id"), F.col("component").alias("family")).join(weight, "doc_id"), "families")
    pivots = family.groupBy("family").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("back"))).alias("p"), F.count(F.lit(1)).alias("m"))
    pivots = staged(pivots.select("family", (-F.col("p.back")).alias("pivot"), "m"), "pivots")
    sets = staged(sets.join(family.select("doc_id", "family"), "doc_id"), "family-sets")
    centre = pivots.join(sets.select(F.col("doc_id").alias("pivot"), F.col("tokens").alias("y")), "pivot").select("family", "pivot", "m", "y")
    both = F.size(F.array_intersect("tokens", "y"))
    tested = sets.join(centre, "family").select(
        "doc_id", "family", "pivot", "m", (100 * both >= percent * (F.size("tokens") + F.size("y") - both)).alias("near"))
    tested = staged(tested, "pivot-tests")
    star = tested.where("near and doc_id != pivot").select(F.col("doc_id").alias("src"), F.col("pivot").alias("dst"))
    far = tested.where("not near").groupBy("family").agg(F.count(F.lit(1)).alias("n_far"))
    placed = tested.join(far, "family").select("doc_id", "family", "near", F.ceil(F.col("n_far") / block).alias("k_far"),
                                               F.ceil((F.col("m") - F.col("n_far")) / block).alias("k_near"))
    mine = F.pmod(F.xxhash64("doc_id"), F.when(F.col("near"), F.col("k_near")).otherwise(F.col("k_far")))
    placed = placed.withColumn("mine", mine)
    # A stray meets strays of its own and later blocks, and every near block.
    others = F.sequence(F.lit(0).cast("long"), F.col("k_far") - 1)
    cells = F.when(F.col("near"), F.transform(others, lambda o: F.struct(o.alias("i"), (-1 - F.col("mine")).alias("j")))).otherwise(
        F.concat(F.transform(others, lambda o: F.struct(F.least(o, F.col("mine")).alias("i"), F.greatest(o, F.col("mine")).alias("j"))),
                 F.transform(F.when(F.col("k_near") > 0, F.sequence(F.lit(0).cast("long"), F.col("k_near") - 1)).otherwise(
                     F.array().cast("array<bigint>")), lambda o: F.struct(F.col("mine").alias("i"), (-1 - o).alias("j")))))
    dealt = placed.select("doc_id", "family", "mine", "near", F.explode(cells).alias("cell"))
    dealt = dealt.select("family", "cell.i", "cell.j", "doc_id", ((~F.col("near")) & (F.col("mine") == F.col("cell.i"))).alias("left"))

    def verify(table: pa.Table) -> pa.Table:
        ids = np.asarray(table["doc_id"])
        order = np.argsort(ids)
        table, ids = table.take(order), ids[order]
        left, tokens = np.asarray(table["left"]), [np.asarray(x.values) for x in table["tokens"]]
        src, dst = [], []
        size = np.array([len(x) for x in tokens], np.int64)
        a = np.flatnonzero(left)
        b = a if left.all() else np.flatnonzero(~left)
        if len(a) and len(b):
            both = _overlaps([tokens[i] for i in a], [tokens[i] for i in b])
            p, q = np.nonzero(100 * both >= percent * (size[a][:, None] + size[b] - both))
            p, q = a[p], b[q]
            p, q = p[p != q], q[p != q]
            for k in _forest(p, q, len(ids)):
                src.append(ids[p[k]])
                dst.append(ids[q[k]])
        return pa.table([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

    blocks = (dealt.join(sets.select("doc_id", "tokens"), "doc_id").groupBy("family", "i", "j")
              .applyInArrow(verify, "src long, dst long"))
    return star.unionByName(blocks)


def links(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, large: int = LARGE, block: int = BLOCK,
          doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): members (doc_id, n, representative) of every non-null
    id; links (src, dst) between representatives that span all components."""
    if not 80 <= percent <= 99:
        raise ValueError("a similarity of 80 to 99 percent is needed")
    text_batches(docs.sparkSession)
    sketch = staged(token_sets(docs, size, doc_id, text, percent), "sketches")
    one = staged(sketch.groupBy("doc_id").agg(F.max(F.struct("n", "f1", "f2")).alias("s")).select("doc_id", "s.*"), "fingerprints")
    classes = staged(one.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("representative")), "classes")
    # Empty sets link with nothing: each stands for itself.
    keep = F.when(F.col("n") > 0, F.col("representative")).otherwise(F.col("doc_id"))
    members = one.join(classes, ["n", "f1", "f2"]).select("doc_id", "n", keep.alias("representative"))
    # Sets of fewer tokens than t / (1 - t) link with equal ones only.
    large_enough = classes.where(F.col("n") > (percent - 1) // (100 - percent)).withColumnRenamed("representative", "doc_id")
    own = staged(sketch.join(large_enough, ["doc_id", "n", "f1", "f2"]).dropDuplicates(["doc_id"]), "representatives")
    left = staged(_survivors(own, percent), "survivors")
    wanted = unused("wanted", docs)
    again = docs.join(bounded(left.select(F.col("doc_id").alias(wanted))), F.col(doc_id).cast("long") == F.col(wanted), "left_semi")
    sets = token_sets(again, size, doc_id, text).join(left, ["doc_id", "f1", "f2"]).dropDuplicates(["doc_id"])
    sets = staged(sets.select("doc_id", "tokens"), "sets")
    shared = _with_frequency(sets.select("doc_id", F.explode("tokens").alias("token")))
    rows = shared.groupBy("doc_id").agg(F.collect_list(F.struct("df", "token")).alias("t"))
    rows = rows.join(sets.select("doc_id", F.size("tokens").cast("long").alias("n")), "doc_id")
    entries = staged(_signatures(rows, percent, large), "signatures")
    buckets = staged(entries.groupBy("sig").agg(F.count(F.lit(1)).alias("members")).where("members >= 2"), "bucket-sizes")
    entries = staged(join_by_weight(entries, buckets, "sig", "members"), "buckets")
    pairs = _verified_pairs(entries.where(F.col("members") <= large), sets, percent)
    families = _family_links(entries.where(F.col("members") > large).select("sig", "doc_id"), sets, percent, block)
    return members, staged(pairs.unionByName(families), "links")


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest id that is reachable
    by links, for every different non-null id.

    Null and empty texts, and texts of white space, have no shingles and link
    with nothing; texts of fewer words than ``size`` have one. Equal sets
    always link. If rows repeat an id with different texts, the one with the
    largest set (then fingerprint) counts. Null ids are left out; an empty table
    gives an empty table; other columns are ignored.
    """
    members, found = links(docs, size, percent, doc_id=doc_id, text=text, **options)
    classes = components(found)
    out = members.withColumnRenamed("n", "n_shingles")
    if classes is None:
        return out.withColumnRenamed("representative", "component_id")
    # A class is named by its smallest id, so the smallest class name is the smallest id.
    out = out.join(classes.withColumnRenamed("node", "representative"), "representative", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "representative").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with the smallest id of each component; all its rows if ids
    repeat, and all rows with a null id. Null, empty and white texts link with
    nothing and stay; equal texts are one component, so ties go to the smallest
    id. An empty table gives an empty table."""
    found = near_duplicates(docs, doc_id=doc_id, **options)
    copy = unused("copy", docs)
    gone = staged(found.where("component_id != doc_id").select(F.col("doc_id").alias(copy)), "near-copies")
    return docs.join(bounded(gone), F.col(doc_id).cast("long") == F.col(copy), "left_anti")
