"""Hard negatives by an inverted multi-index over integer vectors.

The two halves of a vector have a codebook each; a pair of codes is a cell. For a query, the
inner product of a half with a code's centre plus the code's radius times the half's norm
bounds every row of that code from above. Cells are visited in falling order of the sum of
both bounds, which a heap over the two sorted half-score lists yields one by one (the
multi-sequence walk). A search is a set of score windows, each asking for its first ``k``
rows; a window is certified when the next cell's bound is below its k-th score, or below the
window itself. So results are exact, whatever the sample the codebooks come from.

Rounds visit four times as many rows each, until every query is certified. A round joins
(query, cell) requests with the cells' rows, in blocks of bounded size on both sides.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

# Codebooks: vectors they are fitted on (those with the smallest hashes), passes over them,
# and most codes a half. All rows are in the index.
SAMPLE_VECTORS = 20_000
FIT_PASSES = 8
MOST_CODES = 256
# Rows and queries that meet at a time, and rows that the first round visits.
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024
FIRST_VISIT = 8192

NO_CAP = (1 << 62) - 1
NO_FLOOR = -(1 << 62)


@dataclass(frozen=True)
class Codebooks:
    """Centres per half, how many leading components the first half has, and of all vectors the longest."""

    first: np.ndarray
    second: np.ndarray
    split: int
    width: int


@dataclass(frozen=True)
class Cells:
    """Radius of every code, and rows of every cell."""

    first_radius: np.ndarray
    second_radius: np.ndarray
    rows: np.ndarray


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out[owner, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point where every partial sum is exact."""
    reach = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if reach < 2**53:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    return queries @ rows.T


def _centres(points: np.ndarray, codes: int) -> np.ndarray:
    """Lloyd's passes from points spread over the sample."""
    centres = points[np.linspace(0, len(points) - 1, codes).astype(int)].copy()
    for _ in range(FIT_PASSES):
        code = _nearest(points, centres)
        seen = np.bincount(code, minlength=codes)
        sums = np.zeros_like(centres)
        np.add.at(sums, code, points)
        centres[seen > 0] = sums[seen > 0] / seen[seen > 0, None]
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def fit_codebooks(rows: DataFrame, sample: int = SAMPLE_VECTORS) -> Codebooks:
    """Codebooks of (row, vector), from at most ``sample`` vectors; about n**(1/4) codes a half."""
    counted = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    width = max(1, counted["width"] or 0)
    codes = int(min(MOST_CODES, max(2, 2 ** round(np.log2(max(1, counted["n"])) / 4))))
    chosen = rows.orderBy(F.xxhash64("vector"), "row").limit(sample).select("vector").toArrow()
    points = matrix(chosen.column("vector").combine_chunks(), width).astype(np.float64)
    if not len(points):
        points = np.zeros((1, width))
    split = max(1, width // 2)
    return Codebooks(_centres(points[:, :split], codes), _centres(points[:, split:], codes), split, width)


def _assign(books_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = books_of.value
        for batch in batches:
            vectors = matrix(batch.column("vector"), books.width).astype(np.float64)
            codes, radii = [], []
            for half, centres in ((vectors[:, : books.split], books.first), (vectors[:, books.split :], books.second)):
                code = _nearest(half, centres)
                codes.append(code)
                radii.append(np.sqrt(((half - centres[code]) ** 2).sum(axis=1)))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(codes[0] * len(books.second) + codes[1], pa.int64()),
                    *(pa.array(x, pa.float64()) for x in radii),
                ],
                [*batch.schema.names, "cell", "radius_1", "radius_2"],
            )

    return run


def build_index(rows: DataFrame, books: Codebooks) -> tuple[DataFrame, Cells]:
    """(``rows`` with their cell, written; radii and rows of the cells) of (row, id, label, vector)."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    schema = "row long, id long, label long, vector array<long>, cell long, radius_1 double, radius_2 double"
    index = stage(rows.select("row", "id", "label", "vector").mapInArrow(_assign(shared), schema), "index")
    # At most MOST_CODES**2 rows.
    found = index.groupBy("cell").agg(F.count("*").alias("n"), F.max("radius_1"), F.max("radius_2")).collect()
    first, second = np.zeros(len(books.first)), np.zeros(len(books.second))
    counts = np.zeros((len(first), len(second)), np.int64)
    for cell, n, radius_1, radius_2 in found:
        i, j = divmod(cell, len(second))
        counts[i, j] = n
        first[i], second[j] = max(first[i], radius_1), max(second[j], radius_2)
    return index.drop("radius_1", "radius_2"), Cells(first, second, counts)


def walk_cells(query: np.ndarray, books: Codebooks, cells: Cells) -> Iterator[tuple[float, float, int, int]]:
    """(upper bound, lower bound, i, j) of all cells, upper bounds falling."""
    halves = []
    for half, centres, radius in (
        (query[: books.split], books.first, cells.first_radius),
        (query[books.split :], books.second, cells.second_radius),
    ):
        middle, reach = centres @ half, np.sqrt((half.astype(np.float64) ** 2).sum()) * radius
        slack = 1e-9 * (np.abs(middle).max() + reach.max() + 1)
        upper = middle + reach + slack
        order = np.argsort(-upper, kind="stable")
        halves.append((upper[order].tolist(), (middle - reach - slack)[order].tolist(), order.tolist()))
    (up_1, low_1, code_1), (up_2, low_2, code_2) = halves
    heap = [(-(up_1[0] + up_2[0]), 0, 0)]
    while heap:
        bound, x, y = heapq.heappop(heap)
        yield -bound, low_1[x] + low_2[y], code_1[x], code_2[y]
        if y + 1 < len(up_2):
            heapq.heappush(heap, (-(up_1[x] + up_2[y + 1]), x, y + 1))
        if y == 0 and x + 1 < len(up_1):
            heapq.heappush(heap, (-(up_1[x + 1] + up_2[0]), x + 1, 0))


def _request(shared, visited: int, budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, cells = shared.value
        for batch in batches:
            vectors = matrix(batch.column("vector"), books.width).astype(np.float64)
            windows = batch.column("windows").to_pylist()
            at, chosen = [], []
            for k in range(len(batch)):
                floor = min(w["floor"] for w in windows[k])
                cap = max(w["cap"] for w in windows[k])
                seen = 0
                for upper, lower, i, j in walk_cells(vectors[k], books, cells):
                    if upper < floor:
                        break
                    if seen >= budget:
                        at.append(k)
                        chosen.append(-1)
                        break
                    rows = int(cells.rows[i, j])
                    if rows and seen >= visited and lower <= cap:
                        at.append(k)
                        chosen.append(i * len(books.second) + j)
                    seen += rows
            picked = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(chosen, pa.int64())], [*picked.schema.names, "cell"]
            )

    return run


_QUERY = "q long, label long, vector array<long>, windows array<struct<cap: long, floor: long>>"


def _score(width: int, same_label: bool, k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if queries.num_rows and rows.num_rows:
            scores = products(
                matrix(queries.column("vector").combine_chunks(), width),
                matrix(rows.column("vector").combine_chunks(), width),
            )
            labels = rows.column("label").to_numpy()
            ids = rows.column("id").to_numpy()
            numbers = rows.column("row").to_numpy()
            windows = queries.column("windows").to_pylist()
            names, own = queries.column("q").to_pylist(), queries.column("label").to_numpy()
            for place in range(len(names)):
                line = scores[place]
                fit = np.flatnonzero((labels == own[place]) == same_label)
                fit = fit[line[fit] >= min(w["floor"] for w in windows[place])]
                if not len(fit):
                    continue
                fit = fit[np.lexsort((numbers[fit], ids[fit], -line[fit]))]
                falling = -line[fit]
                for w in windows[place]:
                    low = int(np.searchsorted(falling, -w["cap"]))
                    high = min(low + k, int(np.searchsorted(falling, -w["floor"], "right")))
                    found += [
                        (names[place], w["cap"], int(ids[x]), int(numbers[x]), int(line[x])) for x in fit[low:high]
                    ]
        columns = list(zip(*found, strict=True)) if found else [[]] * 5
        return pa.table(
            {c: pa.array(x, pa.int64()) for c, x in zip(("q", "cap", "id", "row", "score"), columns, strict=True)}
        )

    return run


def search(
    index: DataFrame, books: Codebooks, cells: Cells, queries: DataFrame, windows: DataFrame, same_label: bool, k: int
) -> DataFrame:
    """(q, cap, id, row, score, rank): the first ``k`` rows of every window, exact.

    ``queries`` (q, label, vector), ``windows`` (q, cap, floor): scores from floor to cap. Rows
    with the query's label count if ``same_label``, else all others. Higher scores come first,
    then smaller ids, then smaller row numbers.
    """
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast((books, cells))
    order = Window.partitionBy("q", "cap").orderBy(F.desc("score"), "id", "row")
    result = "q long, cap long, id long, row long, score long"
    best = spark.createDataFrame([], f"{result}, rank int")
    visited, budget = 0, FIRST_VISIT
    while True:
        last = best.groupBy("q", "cap").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        state = (
            windows.join(last, ["q", "cap"], "left")
            .withColumn("floor", F.when(F.col("n") >= k, F.greatest("floor", "least")).otherwise(F.col("floor")))
            .groupBy("q")
            .agg(F.collect_list(F.struct("cap", "floor")).alias("windows"))
            .join(queries, "q")
            .select("q", "label", "vector", "windows")
        )
        asked = stage(state.mapInArrow(_request(shared, visited, budget), f"{_QUERY}, cell long"), "requests")
        # At most MOST_CODES**2 rows: how requests and rows of a cell are dealt.
        parts = asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("long").alias("parts"))
        sizes = index.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("long").alias("blocks"))
        dealt = F.broadcast(parts.filter("cell >= 0").join(sizes, "cell"))
        first = F.lit(0).cast("long")
        left = (
            asked.join(dealt, "cell")
            .withColumn("block", F.explode(F.sequence(first, F.col("blocks") - 1)))
            .withColumn("part", F.pmod(F.xxhash64("q"), "parts"))
            .select("cell", "block", "part", "q", "label", "vector", "windows")
        )
        right = (
            index.join(dealt, "cell")
            .withColumn("part", F.explode(F.sequence(first, F.col("parts") - 1)))
            .withColumn("block", F.pmod(F.xxhash64("row"), "blocks"))
            .select("cell", "block", "part", "id", "row", "label", "vector")
        )
        keys = ("cell", "block", "part")
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_score(books.width, same_label, k), result)
        best = stage(
            best.select("q", "cap", "id", "row", "score")
            .unionByName(found)
            .withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k),
            "best",
        )
        if asked.filter("cell < 0").isEmpty():
            return best
        visited, budget = budget, budget * 4


def usable_rows(vectors: DataFrame) -> DataFrame:
    """(id, label, vector) of the rows that take part, each once: components x as floor(256 * x).

    Rows with a null label, a null vector or a null or non-finite component are left out.
    """
    broken = F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )
    return (
        vectors.filter("label is not null and embedding is not null")
        .filter(~broken)
        .select(
            F.col("vec_id").cast("long").alias("id"),
            F.col("label").cast("long").alias("label"),
            F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double"))).alias("vector"),
        )
        .distinct()
    )


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    sample: int = SAMPLE_VECTORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` (id, label, vector of integers); ``anchors`` says which of them are anchors. An
    anchor's positives are its first ``positives`` other rows of its label by inner product,
    ties by smaller id. For each of them, the first ``negatives`` rows of other labels whose
    score is at least ``percent`` % of the positive's and not above it. Equal rows count once.
    Rows without an id can be positives and negatives with a null id, after all others that
    tie with them. Vectors shorter than the longest are filled up with zeros. Scores must fit
    in a long. An empty table, or one without anchors, gives no row.
    """
    numbered = stage(
        rows.select(F.coalesce("id", F.lit((1 << 63) - 1)).alias("id"), "label", "vector", anchors.alias("is_anchor"))
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    # Of rows with one label and vector, only the first few can be among the first of a window.
    most = max(positives + 1, negatives)
    copies = Window.partitionBy("label", "vector").orderBy("id", "row")
    kept = numbered.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= most).drop("copy")
    kept = stage(kept, "kept-vectors")
    books = fit_codebooks(kept, sample)
    index, cells = build_index(kept, books)
    asking = numbered.filter("is_anchor").select("row", "id", "label", "vector")
    queries = stage(
        asking.select("label", "vector").distinct().withColumn("q", F.monotonically_increasing_id()), "queries"
    )
    named = asking.join(queries, ["label", "vector"]).select(
        F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"), "q"
    )
    whole = queries.select("q", F.lit(NO_CAP).alias("cap"), F.lit(NO_FLOOR).alias("floor"))
    near = search(index, books, cells, queries, whole, True, positives + 1)
    order = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "id", "row")
    pairs = stage(
        named.join(near.select("q", "id", "row", "score"), "q")
        .filter("row != anchor_row")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= positives)
        .select("q", "anchor_row", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("cap"), "place"),
        "positives",
    )
    windows = stage(
        pairs.select("q", "cap").distinct().withColumn("floor", F.expr(f"({percent} * cap + 99) div 100"))
        # No score is both below a negative one and at least a part of it.
        .filter("cap >= 0"),
        "score-windows",
    )
    far = search(index, books, cells, queries, windows, False, negatives)
    named_id = [F.expr(f"nullif({c}, 9223372036854775807)").alias(c) for c in ("anchor_id", "positive_id")]
    return pairs.join(far.select("q", "cap", "id", "score", "rank"), ["q", "cap"]).select(
        *named_id,
        "rank",
        F.expr("nullif(id, 9223372036854775807)").alias("negative_id"),
        F.col("cap").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def negatives_of_embeddings(vectors: DataFrame) -> DataFrame:
    """Hard negatives of (vec_id, embedding, label); see ``hard_negatives``.

    Labels of ids divisible by 7 move to the next of ten; anchors are the ids divisible by 100.
    """
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable_rows(vectors).withColumn("label", moved).distinct()
    return hard_negatives(rows, F.coalesce(F.col("id") % 100 == 0, F.lit(False)))
