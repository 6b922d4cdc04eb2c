"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner products are nearest neighbours by Euclidean distance after one more
component brings all vectors to the largest norm and the queries to the sphere. The index is
cut into ranges of norms, a factor of two each, and every range has its own largest norm,
so that a few long vectors do not crowd all others into the same cells. Each
table hashes with several p-stable (Gaussian) projections cut into cells. A query visits
its own bucket and perturbed ones, in the order of estimated success: the squared
distances to the cell borders that have to be crossed, summed. In each bucket the exact
products are computed in double precision, and the best of all tables are merged.

Tables, hashes, cell width and probes of a range are chosen from the data. PILOTS queries are
compared with all rows in one pass; of the settings that find RECALL of their exact neighbours
in the range, the one with the least work is taken, which depends on the number of rows. SAMPLE
rows of each range tell how many rows a setting visits. A range that holds fewer than ENOUGH of
these neighbours takes the setting that all neighbours together ask for. Only if no setting
reaches the recall, all rows of the range are one cell. The size of a table or range switches
nothing else; ``whole`` says which ranges are to be searched exactly (none by default).
Queries that have found fewer than asked for, although there are more ids, are compared
with all rows.

A bucket is cut into blocks of about BLOCK vectors, and so are the queries that visit it.
Each block of queries meets each block of vectors and keeps its own best, so a bucket may
hold a third of all rows without going to one task, and none of its rows is left out. Every
row with a usable vector is indexed; projections come from a fixed seed.

Vectors that are null, empty, zero, of another length than most have, or that hold null
or non-finite components take no part, and ids that are null do neither. Rows that
repeat an id are candidates each for itself; the better one counts. Equal products
go to the smaller id. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.shared import written

TABLES = (1, 2, 4, 8)
HASHES = (1, 2, 3, 4, 6, 8, 12)
WIDTHS = tuple(0.25 * 2 ** (step / 4) for step in range(17))
PROBES = (1, 4, 8, 16, 32)
#: What is asked for is 0.9; the rest is for the error of the estimate.
RECALL = 0.92
PILOTS = 128
SAMPLE = 512
ENOUGH = 200
#: One more copy of a vector costs as much as comparing so many pairs.
COPY = 200
BLOCK = 4096
FOUND = "query_id bigint, vec_id bigint, score double"
_SEED = 11


@dataclass(frozen=True)
class Setting:
    """How the rows of a range are hashed and how many buckets of a table a query visits."""

    tables: int
    hashes: int
    width: float
    probes: int


#: All rows of a range are in one cell.
WHOLE = Setting(1, 1, 1e9, 1)


@dataclass(frozen=True)
class Choice:
    """A setting, the share of pilots' neighbours it finds, and of the rows it compares.

    Rows that a query meets in several tables count several times.
    """

    setting: Setting
    recall: float
    compared: float


@dataclass(frozen=True)
class Hashing:
    """Projections of all tables for vectors of one length."""

    directions: np.ndarray  # table, hash, component
    shifts: np.ndarray  # table, hash
    width: float
    largest: float

    @classmethod
    def make(cls, size: int, largest: float, setting: Setting) -> Hashing:
        """Fewer tables of a setting are the first of more."""
        shape = setting.tables, setting.hashes
        directions = np.random.default_rng(_SEED).normal(size=(*shape, size + 1))
        shifts = np.random.default_rng(_SEED + 1).uniform(0, setting.width, shape)
        return cls(directions, shifts, setting.width, largest)

    def _cells(self, x: np.ndarray) -> np.ndarray:
        """Positions in cells: row, table, hash."""
        return (np.einsum("nd,thd->nth", x, self.directions) + self.shifts) / self.width

    def stored(self, x: np.ndarray) -> np.ndarray:
        """The cells of vectors in each table."""
        scaled = x / self.largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
        return np.floor(self._cells(np.column_stack([scaled, rest]))).astype(np.int64)

    def probed(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The cells that queries visit: row, table, probe, hash; best guess first."""
        unit = x / np.abs(x).max(axis=1, keepdims=True)  # squares of tiny values are zero
        unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        place = self._cells(np.column_stack([unit, np.zeros(len(x))]))
        home = np.floor(place)
        below = place - home  # distance to the lower border, in cells
        rows, tables, hashes = place.shape
        costs = np.stack([below, 1.0 - below], axis=-1).reshape(rows, tables, 2 * hashes) ** 2
        order = np.argsort(costs, axis=-1)
        sets = _perturbations(hashes, max(probes, *PROBES))
        out = np.repeat(home.astype(np.int64)[:, :, None, :], len(sets), axis=2)
        ranked = np.take_along_axis(costs, order, axis=-1)
        # The sets are ranked for every query by its own border distances.
        total = np.stack([ranked[..., list(s)].sum(axis=-1) for s in sets], axis=-1)
        total = np.where(self._clashing(order, sets), np.inf, total)
        best = np.argsort(total, axis=-1, kind="stable")[..., :probes]
        moves = np.zeros((rows, tables, len(sets), hashes), np.int64)
        for number, chosen in enumerate(sets):
            for position in chosen:
                slot = order[..., position]
                step = np.where(slot % 2 == 0, -1, 1)
                r, t = np.indices(slot.shape)
                moves[r, t, number, slot // 2] += step
        picked = np.take_along_axis(out + moves, best[..., None], axis=2)
        # Sets that would move one hash both ways come last and repeat the home cell.
        clash = np.isinf(np.take_along_axis(total, best, axis=-1))
        picked[clash] = out[:, :, : best.shape[-1]][clash]
        return picked

    @staticmethod
    def _clashing(order: np.ndarray, sets: list[tuple[int, ...]]) -> np.ndarray:
        out = []
        for chosen in sets:
            slots = np.sort(order[..., list(chosen)] // 2, axis=-1)
            out.append((slots[..., 1:] == slots[..., :-1]).any(axis=-1))
        return np.stack(out, axis=-1)


def _perturbations(hashes: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of ranked border crossings, likeliest first by their expected costs.

    Twice as many as are visited, as each query orders them anew and some clash.
    """
    m = hashes
    expected = [
        j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m
        else 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
        for j in range(1, 2 * m + 1)
    ]
    sets: list[tuple[int, ...]] = [()]
    heap = [(expected[0], (0,))]
    while heap and len(sets) < 2 * probes + 1:
        cost, chosen = heapq.heappop(heap)
        sets.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            step = expected[last + 1]
            heapq.heappush(heap, (cost - expected[last] + step, (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + step, (*chosen, last + 1)))
    return sets


def _bucket(cells: np.ndarray, table: np.ndarray) -> np.ndarray:
    """One number for table (of a range) and cells; equal cells have equal numbers."""
    value = table.astype(np.uint64) + np.uint64(1)
    for hash_ in range(cells.shape[-1]):
        value = (value ^ cells[..., hash_].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(32)
    return value.view(np.int64)


def usable(vector: Column) -> Column:
    """No null, no NaN, no infinity, and not all zero."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return fine & F.exists(vector, lambda x: x != 0)


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part, components as they are stored."""
    x = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & usable(F.col("x"))
    )
    sizes = rows.groupBy(F.size("x").alias("size")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("x") == F.lit(first.size if first else -1))


def _norm(x: Column) -> Column:
    """Length of a vector, by its largest component, so that no square is lost."""
    large = F.array_max(F.transform(x, lambda v: F.abs(v.cast("double"))))
    squares = F.aggregate(
        x, F.lit(0.0), lambda acc, v: acc + (v.cast("double") / large) * (v.cast("double") / large)
    )
    return F.least(large * F.sqrt(squares), F.lit(np.finfo(float).max.item()))


def _tables(setting: Setting, number: int) -> np.ndarray:
    """Tables of a range, numbered apart from those of others."""
    return np.arange(setting.tables) + (int(number) + 2**15) * 1024


def _matrix(values: pd.Series) -> np.ndarray:
    return np.array(values.tolist(), float).reshape(len(values), -1)


def _best(
    queries: np.ndarray, own: np.ndarray, ids: np.ndarray, x: np.ndarray, most: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its ``most`` best ids of a block and their products, each id once.

    A fast product finds the rows that may be among them; these are computed
    again one by one, so that equal vectors have equal products.
    """
    # Rows of an id stand together, so that its best one can be found.
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    firsts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    longest = np.sqrt((x * x).sum(axis=1).max())
    for start in range(0, len(own), 1024):
        part = slice(start, start + 1024)
        rough = queries[part] @ x.T
        rough[own[part][:, None] == ids[None, :]] = -np.inf
        by_id = np.maximum.reduceat(rough, firsts, axis=1) if len(firsts) < len(ids) else rough
        keep = min(most, by_id.shape[1])
        limit = np.partition(by_id, -keep, axis=1)[:, -keep]
        limit = limit - 1e-12 * np.sqrt((queries[part] ** 2).sum(axis=1)) * longest
        for row, number in enumerate(own[part].tolist()):
            near = np.flatnonzero((rough[row] >= limit[row]) & (rough[row] > -np.inf))
            exact = (x[near] * queries[start + row]).sum(axis=1)
            order = np.lexsort((ids[near], -exact))
            # The first row of each id is its best one.
            order = order[np.sort(np.unique(ids[near][order], return_index=True)[1])[:most]]
            yield number, ids[near][order], exact[order]


def _first_meeting(visited: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The probe by which a query reaches a row in each table; a large number if by none."""
    met = visited == held[..., None]
    return np.where(met.any(axis=-1), met.argmax(axis=-1), 2**30)


def chosen(
    largest: float, queries: np.ndarray, owner: np.ndarray, near: np.ndarray, others: np.ndarray,
    rows: int, asked: int, recall: float = RECALL,
) -> Choice:
    """The setting with the least work among those that reach ``recall``.

    ``near`` are neighbours of the queries ``owner``, ``others`` a sample of the ``rows`` of a
    range, and ``asked`` is the number of all queries.
    """
    best, least = Choice(WHOLE, 1.0, 1.0), np.inf
    few = queries[:32]
    for hashes in HASHES:
        for width in WIDTHS:
            widest = Setting(max(TABLES), hashes, width, max(PROBES))
            hashing = Hashing.make(queries.shape[1], largest, widest)
            numbers = _tables(widest, 0)
            visited = _bucket(hashing.probed(queries, widest.probes), numbers[None, :, None])
            held = _bucket(hashing.stored(near), numbers[None, :])
            found = _first_meeting(visited[owner], held)
            reached = {
                (t, p): float((found[:, :t] < p).any(axis=1).mean()) for t in TABLES for p in PROBES
            }
            if max(reached.values()) < recall:
                continue
            stored = _bucket(hashing.stored(others), numbers[None, :])
            passed = _first_meeting(visited[: len(few), None], stored[None])
            for (tables, probes), share in reached.items():
                if share < recall:
                    continue
                compared = (passed[..., :tables] < probes).mean(axis=(0, 1)).sum()
                visits = tables * min(probes, 3**hashes)
                work = asked * (rows * compared + COPY * visits) + COPY * tables * rows
                if work < least:
                    least = work
                    setting = Setting(tables, hashes, width, probes)
                    best = Choice(setting, share, float(compared))
            if reached[1, 1] >= recall:
                break  # wider cells only hold more
    return best


def _pilot_neighbours(rows: DataFrame, pilots: list, most: int) -> list:
    """(query_id, range, x) of the exact nearest of each pilot, from one pass over all rows."""
    kind = rows.schema["x"].dataType.simpleString()
    held = rows.sparkSession.sparkContext.broadcast(
        (np.array([p["x"] for p in pilots], float), np.array([p["vec_id"] for p in pilots]))
    )

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, own = held.value
        known = pd.DataFrame()
        for frame in frames:
            # The best rows until now are compared again with those of the next batch.
            known = pd.concat([known, frame]) if len(known) else frame
            known = known.sort_values("vec_id", kind="stable", ignore_index=True)
            ids, x = known["vec_id"].to_numpy(), _matrix(known["x"])
            hits = []
            for number, (query, found, scores) in enumerate(_best(queries, own, ids, x, most)):
                starts = np.searchsorted(ids, found, "left")
                stops = np.searchsorted(ids, found, "right")
                places = [a + int((x[a:b] @ queries[number]).argmax()) for a, b in zip(starts, stops)]
                hits.append(pd.DataFrame({"query_id": query, "score": scores, "at": places}))
            out = pd.concat(hits, ignore_index=True)
            rest = known.iloc[out["at"]].reset_index(drop=True)
            out = pd.concat([out[["query_id", "score"]], rest[["vec_id", "range", "x"]]], axis=1)
            known = known.iloc[np.unique(np.concatenate([h["at"] for h in hits]).astype(int))]
        if len(known):
            yield out

    found = rows.select("vec_id", "range", "x").mapInPandas(
        near, f"query_id bigint, score double, vec_id bigint, range int, x {kind}"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"), F.max_by(F.struct("range", "x"), "score").alias("row"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= most)
        .select("query_id", "row.range", "row.x")
        .collect()
    )


def choices(rows: DataFrame, queries: DataFrame, known: list, most: int, recall: float) -> dict:
    """The choice for each range of ``known`` (range, rows, norm, size).

    The driver gets PILOTS queries with their neighbours, and about SAMPLE rows of each range.
    """
    pilots = (
        queries.dropDuplicates(["vec_id"]).orderBy(F.xxhash64("vec_id"), "vec_id")
        .select("vec_id", "x").limit(PILOTS).collect()
    )
    near = _pilot_neighbours(rows, pilots, most) if pilots else []
    if not near:
        return {r["range"]: Choice(WHOLE, 1.0, 1.0) for r in known}
    share = F.create_map(
        *[F.lit(v) for r in known for v in (r["range"], int(1_000_000 * SAMPLE / r["rows"]) + 1)]
    )[F.col("range")]
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "place"), F.lit(1_000_000)) < share
    others: dict[int, list] = {r["range"]: [] for r in known}
    for row in rows.where(drawn).select("range", "x").collect():
        others[row["range"]].append(row["x"])

    asked = queries.count()
    x = np.array([p["x"] for p in pilots], float)
    number = {p["vec_id"]: i for i, p in enumerate(pilots)}
    owner = np.array([number[n["query_id"]] for n in near])
    place = np.array([n["range"] for n in near])
    found = np.array([n["x"] for n in near], float)
    rows_of = {r["range"]: r["rows"] for r in known}
    norm_of = {r["range"]: r["norm"] for r in known}
    # All neighbours together, each at the scale of its own range.
    scale = np.array([norm_of[n] for n in place])
    everywhere = found / scale[:, None]
    drawn_rows = np.concatenate(
        [np.array(o, float) / norm_of[n] for n, o in others.items() if o] or [everywhere]
    )
    total = sum(rows_of.values())
    together = None
    out = {}
    for n, count in rows_of.items():
        own = place == n
        if own.sum() >= ENOUGH and others[n]:
            sample = np.array(others[n], float)
            out[n] = chosen(norm_of[n], x, owner[own], found[own], sample, count, asked, recall)
        else:
            together = together or chosen(1.0, x, owner, everywhere, drawn_rows, total, asked, recall)
            out[n] = together
    return out


def nearest(
    vectors: DataFrame, is_query: Column, most: int = 20, *, recall: float = RECALL,
    setting: Setting | None = None, whole: int = 0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``most`` nearest found for each query.

    ``is_query`` is a condition on vec_id. A query never finds rows of its own id.
    Every range is hashed by ``setting`` if there is one, else by what the data ask for to reach
    ``recall``. Ranges of at most ``whole`` rows are one cell, so that nothing of them is missed.
    """
    usable_rows = usable_vectors(vectors).withColumn("norm", _norm(F.col("x")))
    # Norms of one length, such as 1, are in the middle of a range.
    rows = written(
        usable_rows.withColumns(
            {
                "range": F.floor(F.log2("norm") + 0.5).cast("int"),
                "place": F.monotonically_increasing_id(),
            }
        ),
        "vectors",
    )
    # As many ranges as there are exponents at most.
    known = rows.groupBy("range").agg(
        F.count(F.lit(1)).alias("rows"), F.max("norm").alias("norm"),
        F.first(F.size("x")).alias("size"),
    ).orderBy("range").collect()
    queries = rows.where(is_query)
    if setting:
        settings = {r["range"]: setting for r in known}
    else:
        settings = {n: c.setting for n, c in choices(rows, queries, known, most, recall).items()}
    settings |= {r["range"]: WHOLE for r in known if r["rows"] <= whole}
    return _found(rows, queries, known, settings, most)


def _found(
    rows: DataFrame, queries: DataFrame, known: list, settings: dict[int, Setting], most: int
) -> DataFrame:
    spark = rows.sparkSession
    kind = rows.schema["x"].dataType.simpleString()
    hashings = {
        r["range"]: (s := settings[r["range"]], Hashing.make(r["size"], r["norm"], s)) for r in known
    }
    held = spark.sparkContext.broadcast(hashings)

    def stored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number, part in frame.groupby("range"):
                setting, hashing = held.value[number]
                cells = hashing.stored(_matrix(part["x"]))
                buckets = _bucket(cells, _tables(setting, number)[None, :])
                each = buckets.shape[1]
                yield pd.DataFrame(
                    {
                        "bucket": buckets.ravel(),
                        "place": np.repeat(part["place"].to_numpy(), each),
                        "vec_id": np.repeat(part["vec_id"].to_numpy(), each),
                        "x": [x for x in part["x"] for _ in range(each)],
                    }
                )

    def visited(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in probing(frames):
            counts = out["bucket"].value_counts()
            yield pd.DataFrame({"bucket": counts.index, "n": counts.to_numpy()})

    def probing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), 500):
                part = frame.iloc[start : start + 500]
                x = _matrix(part["x"])
                buckets = np.column_stack(
                    [
                        _bucket(h.probed(x, s.probes), _tables(s, n)[None, :, None]).reshape(len(x), -1)
                        for n, (s, h) in held.value.items()
                    ]
                )
                each = buckets.shape[1]
                out = pd.DataFrame(
                    {
                        "bucket": buckets.ravel(),
                        "place": np.repeat(part["place"].to_numpy(), each),
                        "query_id": np.repeat(part["vec_id"].to_numpy(), each),
                        "q": np.repeat(np.arange(len(part)), each),
                    }
                ).drop_duplicates()
                own = part["x"].tolist()
                yield out.assign(x=[own[i] for i in out["q"]])[["bucket", "place", "query_id", "x"]]

    index = rows.mapInPandas(stored, f"bucket bigint, place bigint, vec_id bigint, x {kind}")
    index = written(index, "vector-index")
    # Blocks of a bucket: as many as its rows and the queries that visit it need. Both
    # are dealt by their places and not by their ids, which may repeat.
    visits = queries.mapInPandas(visited, "bucket bigint, n bigint").groupBy("bucket")
    parts = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    sizes = written(
        index.groupBy("bucket").agg(parts(F.count(F.lit(1))).alias("blocks"))
        .join(visits.agg(parts(F.sum("n")).alias("asked")), "bucket"),
        "bucket-sizes",
    )
    index = index.join(sizes, "bucket").selectExpr(
        "bucket", "cast(pmod(xxhash64(place), blocks) AS int) AS block",
        "explode(sequence(0, asked - 1)) AS turn", "vec_id", "x",
    )
    visits = (
        queries.mapInPandas(probing, f"bucket bigint, place bigint, query_id bigint, x {kind}")
        .join(sizes, "bucket")
        .selectExpr(
            "bucket", "explode(sequence(0, blocks - 1)) AS block",
            "cast(pmod(xxhash64(place), asked) AS int) AS turn", "query_id", "x",
        )
    )

    found = (
        visits.groupBy("bucket", "block", "turn")
        .cogroup(index.groupBy("bucket", "block", "turn"))
        .applyInPandas(_comparing(most), FOUND)
    )
    ranked = written(_ranked(found, most), "neighbours")
    # Those that found nothing are not among the ranked ones.
    there = min(most, rows.select("vec_id").distinct().limit(most + 1).count() - 1)
    asked = queries.select(F.col("vec_id").alias("query_id")).distinct()
    counts = ranked.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    short = written(
        asked.join(counts, "query_id", "left")
        .where(F.coalesce("n", F.lit(0)) < F.lit(there))
        .select("query_id"),
        "short-queries",
    )
    if short.isEmpty():
        return ranked
    rest = _against_all(rows, short, most)
    return ranked.join(short, "query_id", "left_anti").unionByName(rest)


def _against_all(rows: DataFrame, short: DataFrame, most: int) -> DataFrame:
    """The exact nearest of the queries in ``short``: every block of them meets every block of rows."""
    ids = short.select(F.col("query_id").alias("vec_id"))
    queries = written(rows.join(ids, "vec_id", "left_semi").select("place", "vec_id", "x"), "short-vectors")
    row_blocks, query_blocks = (max(1, -(-df.count() // BLOCK)) for df in (rows, queries))

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        # By place, as ids may repeat.
        return df.withColumn(own, F.pmod(F.xxhash64("place"), F.lit(parts))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(others - 1).cast("bigint")))
        )

    asked = dealt(queries, "q", query_blocks, "r", row_blocks)
    met = dealt(rows.select("place", "vec_id", "x"), "r", row_blocks, "q", query_blocks)
    found = (
        asked.withColumnRenamed("vec_id", "query_id").groupBy("r", "q")
        .cogroup(met.groupBy("r", "q"))
        .applyInPandas(_comparing(most), FOUND)
    )
    return _ranked(found, most)


def _comparing(most: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def compare(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        hits = []
        if len(asked) and len(block):
            queries, own = _matrix(asked["x"]), asked["query_id"].to_numpy()
            hits = list(_best(queries, own, block["vec_id"].to_numpy(), _matrix(block["x"]), most))
        sizes = [len(ids) for _, ids, _ in hits]
        return pd.DataFrame(
            {
                "query_id": np.repeat(np.array([n for n, _, _ in hits], np.int64), sizes),
                "vec_id": np.concatenate([np.zeros(0, np.int64), *[i for _, i, _ in hits]]),
                "score": np.concatenate([np.zeros(0), *[s for _, _, s in hits]]),
            }
        )

    return compare


def _ranked(found: DataFrame, most: int) -> DataFrame:
    """Each partial task's best are merged with a window over the distinct candidates."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= most)
        .select("query_id", "rank", "vec_id", "score")
    )
