"""Exact top-k inner products by a three-phase uniform threshold."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

VECTORS_A_BLOCK, QUERIES_A_BLOCK = 4096, 512
#: Score lists: the components are cut into this many slices, each with a list of partial scores of its own.
LISTS = 2
#: Partial results are merged this many blocks at a time.
FAN = 64
#: Blocks meet in tiles of this many query blocks by as many vector blocks, so a block is copied once a tile.
TILE = 4
#: Pairs resolved at a time.
PAIRS = 1 << 16
#: Most partitions of a join of blocks.
PARTITIONS = 1 << 14
NONE = -(1 << 62)
PACKED = "block long, slice int, lead binary, solo binary, mat binary, ids binary, counts binary, sizes binary"
ENTRIES = "qblock long, vblock long, slice int, qpos array<int>, pos array<int>, part array<long>"
BEST = "query_id long, vblock long, best array<struct<neg: long, id: long>>"


def _pack(width):
    """One block of distinct vectors as one row a slice of ``width`` components; members with the first."""
    def run(table):
        import pyarrow as pa

        vecs, members = (table.column(c).combine_chunks() for c in ("vec", "members"))
        lengths = vecs.value_lengths().to_numpy(zero_copy_only=False)
        mat = np.zeros((len(lengths), LISTS * width), np.int64)
        mat[np.arange(LISTS * width)[None, :] < lengths[:, None]] = vecs.flatten().to_numpy(zero_copy_only=False)
        ids, counts = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in members.flatten().flatten())
        sizes = members.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        lead = ids[np.cumsum(sizes) - sizes]
        kind = np.int16 if np.abs(mat).max(initial=0) < 2 ** 15 else np.int64
        first = [x.tobytes() for x in (ids, counts, sizes)]
        rows = [(table.column("block")[0].as_py(), s, lead.tobytes(), (sizes == 1).tobytes(),
                 mat[:, s * width:(s + 1) * width].astype(kind).tobytes(), *(first if s == 0 else [b""] * 3)) for s in range(LISTS)]
        types = [pa.int64(), pa.int32()] + [pa.binary()] * 6
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                        names=["block", "slice", "lead", "solo", "mat", "ids", "counts", "sizes"])
    return run


def _matrix(data, n, width):
    return np.frombuffer(data, np.int16 if len(data) == 2 * n * width else np.int64).reshape(n, width)


def _scores(q, v):
    """Partial scores of a cell, exact: in float64 while all sums stay below 2 ** 53, else in integers."""
    top = np.abs(q.astype(np.float64)).max(initial=0) * np.abs(v.astype(np.float64)).max(initial=0) * max(q.shape[1], 1)
    kind = np.float64 if top < 2 ** 53 else np.int64
    return (q.astype(kind) @ v.astype(kind).T).astype(np.int64)


def _slices(batches, width):
    """The rows of a join of slices, with their vectors and their list's part of the cell's scores."""
    for b in batches:
        for i in range(b.num_rows):
            r = {c: b.column(c)[i].as_py() for c in b.schema.names}
            qids, lead = np.frombuffer(r["q_lead"], np.int64), np.frombuffer(r["v_lead"], np.int64)
            solo = np.frombuffer(r["v_solo"], bool)
            yield r, qids, lead, solo, _scores(_matrix(r["q_mat"], len(qids), width), _matrix(r["v_mat"], len(lead), width))


def _struct_lists(sizes, **fields):
    import pyarrow as pa

    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], names=list(fields)))


def _gather(k, width):
    """Phase 1: the ``k`` highest entries of one list in a cell, for every query of the block."""
    def run(batches):
        import pyarrow as pa

        for r, qids, lead, solo, scores in _slices(batches, width):
            found = []
            for i, q in enumerate(qids):
                others = np.flatnonzero(~(solo & (lead == q)))
                near = min(k, len(others))
                at = others[np.argpartition(-scores[i, others], near - 1)[:near]] if near else others
                found.append((at, scores[i, at]))
            at, part = (np.concatenate([f[j] for f in found]) for j in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(qids), r["qblock"], np.int64)), pa.array(np.arange(len(qids), dtype=np.int32)),
                 pa.array(np.full(len(qids), r["slice"], np.int32)), pa.array(np.full(len(qids), r["vblock"], np.int64)),
                 _struct_lists([len(f[0]) for f in found], neg=-part, vblock=np.full(len(at), r["vblock"], np.int64), pos=at.astype(np.int32))],
                names=["qblock", "qpos", "slice", "vblock", "best"])
    return run


def _floors(r, qids):
    """The cutoff of each query of the block; ``NONE`` where fewer than k rows are there."""
    cut = dict(zip(r["cut_ids"], r["cuts"]))
    return np.array([cut.get(q, NONE) for q in qids.tolist()], np.int64)


def _collect(width):
    """Phase 2: the entries of one list at or above cutoff / LISTS; a score at the cutoff has such an entry in some list."""
    def run(batches):
        import pyarrow as pa

        for r, qids, lead, solo, scores in _slices(batches, width):
            enough = -(-_floors(r, qids) // LISTS)
            qpos, pos = np.nonzero(scores >= enough[:, None])
            other = ~(solo[pos] & (lead[pos] == qids[qpos]))
            qpos, pos = qpos[other], pos[other]
            if len(qpos):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["qblock"]], pa.int64()), pa.array([r["vblock"]], pa.int64()), pa.array([r["slice"]], pa.int32()),
                     pa.array([qpos.astype(np.int32)], pa.list_(pa.int32())), pa.array([pos.astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([scores[qpos, pos]], pa.list_(pa.int64()))],
                    names=["qblock", "vblock", "slice", "qpos", "pos", "part"])
    return run


def _resolve(k, width):
    """The collected entries of a cell with the parts that no list has sent, and each query's ``k`` best
    rows among them at or above its cutoff, ties to the smaller id."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i].as_py() for c in b.schema.names if c != "want"}
                ids, counts, sizes = (np.frombuffer(r[c], np.int64) for c in ("v_ids", "v_counts", "v_sizes"))
                qids, n = np.frombuffer(r["q_lead"], np.int64), len(sizes)
                slices, qpos, pos, part = b.column("want")[i].values.flatten()
                wants = [(slices[j].as_py(), qpos[j].values.to_numpy() * np.int64(n) + pos[j].values.to_numpy(),
                          part[j].values.to_numpy()) for j in range(len(slices))]
                pairs = np.unique(np.concatenate([w[1] for w in wants]))
                score = np.zeros(len(pairs), np.int64)
                for s in range(LISTS):
                    missing = np.ones(len(pairs), bool)
                    for _, keys, parts in (w for w in wants if w[0] == s):
                        at = np.searchsorted(pairs, keys)
                        score[at] += parts
                        missing[at] = False
                    q, v = _matrix(r["q_mats"][s], len(qids), width), _matrix(r["v_mats"][s], n, width)
                    left = np.flatnonzero(missing)
                    for cut in range(0, len(left), PAIRS):
                        at = left[cut:cut + PAIRS]
                        score[at] += np.einsum("ij,ij->i", q[pairs[at] // n].astype(np.int64), v[pairs[at] % n].astype(np.int64))
                pairs, score = (x[score >= _floors(r, qids)[pairs // n]] for x in (pairs, score))
                of = pairs % n
                begin = (np.cumsum(sizes) - sizes)[of]
                row = np.repeat(np.arange(len(of)), sizes[of])
                member = np.arange(len(row)) - np.repeat(np.cumsum(sizes[of]) - sizes[of], sizes[of]) + begin[row]
                other = ids[member] != qids[pairs[row] // n]
                row, member = row[other], member[other]
                row, member = (np.repeat(x, counts[member]) for x in (row, member))
                q, neg, vid = pairs[row] // n, -score[row], ids[member]
                order = np.lexsort((vid, neg, q))
                q, neg, vid = q[order], neg[order], vid[order]
                keep = np.arange(len(q)) - np.searchsorted(q, q) < k
                q, neg, vid = q[keep], neg[keep], vid[keep]
                asked, sizes_of = np.unique(q, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids[asked]), pa.array(np.full(len(asked), r["vblock"], np.int64)), _struct_lists(sizes_of, neg=neg, id=vid)],
                    names=["query_id", "vblock", "best"])
    return run


def _merge(lists: DataFrame, blocks: int, k: int, *keys: str) -> DataFrame:
    """One list of the ``k`` least entries a key from one a block, merged FAN blocks at a time."""
    while True:
        merged = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best")
        if blocks <= FAN:
            return lists.groupBy(*keys).agg(merged)
        lists = lists.groupBy(*keys, F.floor(F.col("vblock") / FAN).alias("vblock")).agg(merged)
        blocks = -(-blocks // FAN)


class Lists:
    """The score lists of a table: packed blocks of distinct vectors and of queries, and the three phases over them."""

    def __init__(self, vectors: DataFrame, is_query: Column, k: int, id_col: str, vec_col: str, scale: float):
        x = F.col(vec_col)
        ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
        usable = vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & F.coalesce(ok, F.lit(False)))
        ints = usable.select(F.col(id_col).cast("long").alias("id"), is_query.alias("asks"),
                             F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long")).alias("vec"))
        n, asks, dim = ints.agg(F.count("*"), F.count(F.when(F.col("asks"), 1)), F.max(F.size("vec"))).first()
        self.k, self.width = k, max(1, -(-(dim or 0) // LISTS))
        self.v_blocks, self.q_blocks = max(1, -(-n // VECTORS_A_BLOCK)), max(1, -(-asks // QUERIES_A_BLOCK))
        rank = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
        members = (ints.groupBy("vec", "id").agg(F.least(F.count("*"), F.lit(k)).alias("c"))
                   .withColumn("rank", rank).filter(F.col("rank") <= k + 1)
                   .groupBy("vec").agg(F.sort_array(F.collect_list(F.struct("id", "c"))).alias("members")))
        asking = (ints.filter("asks").groupBy("id").agg(F.min("vec").alias("vec"))
                  .select("vec", F.array(F.struct("id", F.lit(1).cast("long").alias("c"))).alias("members"), "id"))
        self.vectors = self._packed(members, self.v_blocks, "v", "vec")
        self.queries = self._packed(asking, self.q_blocks, "q", "id")

    def _packed(self, rows, blocks, a, key):
        cut = rows.select(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), "vec", "members")
        p = stored(cut.groupBy("block").applyInArrow(_pack(self.width), PACKED), f"topk-{a}")
        return p.select(F.col("block").alias(f"{a}block"), "slice", *(F.col(c).alias(f"{a}_{c}") for c in p.columns[2:]))

    def _whole(self, packed, a):
        """All slices of a block in one row."""
        mats = F.sort_array(F.collect_list(F.struct("slice", f"{a}_mat")))
        return packed.groupBy(f"{a}block").agg(mats[f"{a}_mat"].alias(f"{a}_mats"),
                                               *(F.max(f"{a}_{c}").alias(f"{a}_{c}") for c in ("lead", "ids", "counts", "sizes")))

    def _cells(self, queries, vectors, *on):
        """Every query block beside every vector block, met in tiles."""
        q_tiles, v_tiles = (-(-b // TILE) for b in (self.q_blocks, self.v_blocks))

        def tile(a):
            return F.floor(F.col(f"{a}block") / TILE).alias(f"{a}tile")

        def each(tiles, a):
            return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias(f"{a}tile")

        keys = ["qtile", "vtile", *on]
        asked = queries.select("*", tile("q"), *([] if "vtile" in queries.columns else [each(v_tiles, "v")]))
        spread = asked.repartition(min(PARTITIONS, q_tiles * v_tiles * LISTS), *keys)
        return spread.join(vectors.select("*", tile("v"), each(q_tiles, "q")), keys)

    def _resolved(self, wants, queries):
        """``wants`` (cell, list, positions and parts) resolved: one list of best rows a query and vector block."""
        want = F.struct("vblock", "slice", "qpos", "pos", "part")
        by_tile = wants.groupBy("qblock", F.floor(F.col("vblock") / TILE).alias("vtile")).agg(F.collect_list(want).alias("wants"))
        cells = self._cells(queries.join(by_tile, "qblock"), self._whole(self.vectors, "v"))
        of_cell = F.transform(F.filter("wants", lambda w: w["vblock"] == F.col("vblock")),
                              lambda w: F.struct(*(w[c].alias(c) for c in ("slice", "qpos", "pos", "part"))))
        cells = cells.withColumn("want", of_cell).filter(F.size("want") > 0)
        return cells.select("vblock", "q_lead", "q_mats", "cut_ids", "cuts", "v_mats", "v_ids", "v_counts", "v_sizes",
                            "want").mapInArrow(_resolve(self.k, self.width), BEST)

    def _informed(self, queries, cutoffs=None):
        """Query blocks with the cutoffs of their queries."""
        none = F.array().cast("array<long>")
        if cutoffs is None:
            return queries.withColumns({"cut_ids": none, "cuts": none})
        return queries.join(cutoffs, "qblock", "left").withColumns({c: F.coalesce(c, none) for c in ("cut_ids", "cuts")})

    def cutoffs(self) -> DataFrame:
        """Phase 1: each list's ``k`` best, their scores resolved; the k-th best of them, by query block."""
        lists = self._cells(self.queries, self.vectors, "slice").select(
            "qblock", "vblock", "slice", "q_lead", "q_mat", "v_lead", "v_solo", "v_mat").mapInArrow(
            _gather(self.k, self.width),
            "qblock long, qpos int, slice int, vblock long, best array<struct<neg: long, vblock: long, pos: int>>")
        heads = _merge(lists, self.v_blocks, self.k, "qblock", "qpos", "slice").select("qblock", "qpos", F.inline("best")).select(
            "qblock", "qpos", "vblock", "pos").distinct()
        wants = heads.groupBy("qblock", "vblock").agg(F.collect_list("qpos").alias("qpos"), F.collect_list("pos").alias("pos")).select(
            "*", F.lit(-1).alias("slice"), F.array().cast("array<long>").alias("part"))
        best = _merge(self._resolved(wants, self._informed(self._whole(self.queries, "q"))), self.v_blocks, self.k, "query_id")
        kth = best.filter(F.size("best") == self.k).select("query_id", (-F.element_at("best", -1)["neg"]).alias("cut"),
                                                           F.pmod(F.xxhash64("query_id"), F.lit(self.q_blocks)).alias("qblock"))
        return stored(kth.groupBy("qblock").agg(F.collect_list("query_id").alias("cut_ids"), F.collect_list("cut").alias("cuts")), "topk-cutoffs")

    def collected(self, cutoffs: DataFrame) -> DataFrame:
        """Phase 2: of every list the entries that can belong to a score at the cutoff."""
        cells = self._cells(self._informed(self.queries, cutoffs), self.vectors, "slice")
        return cells.select("qblock", "vblock", "slice", "q_lead", "q_mat", "cut_ids", "cuts", "v_lead", "v_solo", "v_mat").mapInArrow(
            _collect(self.width), ENTRIES)

    def resolved(self, entries: DataFrame, cutoffs: DataFrame) -> DataFrame:
        """Phase 3: the missing parts of the entries, and the best rows of each query."""
        found = self._resolved(entries, self._informed(self._whole(self.queries, "q"), cutoffs))
        return _merge(found, self.v_blocks, self.k, "query_id")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 64.0) -> DataFrame:
    """Each query's ``k`` highest inner products over all other rows, exactly.

    Components become floor(scale * x). Equal vectors become one with its k + 1 smallest ids.
    The components are cut into ``LISTS`` slices; every slice is a score list of its own, whose
    partial scores are computed in tasks that see this slice alone, query blocks against
    vector blocks. Phase 1 gathers each list's k best entries; their scores are resolved, and
    the k-th best is a cutoff that k rows reach. Phase 2 sends the cutoffs along with the
    query blocks; of each list the entries at or above cutoff / LISTS are collected, no others.
    A row at the cutoff has such an entry in some list. Phase 3 computes the parts of collected
    entries that no list has sent, for these entries alone, and drops scores below the cutoff.

    Returns query_id, rank, vec_id, score; ties go to the smaller id; fewer rows than k
    give all. Rows with a null id or vector, or with a null or non-finite component, take
    no part; rows with the query's id are not candidates; missing components of shorter
    vectors count 0. Rows that repeat an id are
    candidates each; as a query the smallest of their vectors counts. Empty tables give no rows.
    """
    lists = Lists(vectors, is_query, k, id_col, vec_col, scale)
    cutoffs = lists.cutoffs()
    ranked = lists.resolved(lists.collected(cutoffs), cutoffs).select("query_id", F.posexplode("best").alias("i", "e"))
    return ranked.select("query_id", (F.col("i") + 1).cast("int").alias("rank"),
                         F.col("e.id").alias("vec_id"), (-F.col("e.neg")).alias("score"))
