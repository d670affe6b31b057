"""Top candidates by weighted terms and by vectors."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyweave.functions.text import tokens
from tallyweave.plans.durable import cut, mark

#: Left and right records of a block; a task scores one block of each against the other.
LEFT_BLOCK, RIGHT_BLOCK = 2048, 4096
#: Terms whose left times right records in a pair of blocks are more than this part of all its pairs are multiplied as dense matrices; products of the others that are added at once.
DENSE, PRODUCTS = 0.001, 1 << 19
#: Records of a side of a country that are weighted in one task, about; blocks of right records that a task reads one after the other, and parts of them at least.
CHUNK, RIGHT_BLOCKS, RIGHT_PARTS = 32_768, 64, 3
#: Right records whose pairs are compared in one task, about.
PAIR_PART = 131_072
#: Parts of the terms of a country that are counted each in one task, and what is counted of a term.
TERM_BUCKETS, COUNTS = 256, ("left_df", "right_df", "total", "right_total")


def char_wb_grams(text: Column, sizes: tuple[int, ...] = (2, 3)) -> Column:
    """Character n-grams inside words padded by a blank on each side; a padded word shorter than n is itself a gram."""
    padded = F.transform(tokens(text), lambda t: F.concat(F.lit(" "), t, F.lit(" ")))

    def grams(n: int) -> Column:
        last = lambda t: F.greatest(F.length(t) - (n - 1), F.lit(1))
        return F.flatten(F.transform(padded, lambda t: F.transform(F.sequence(F.lit(1), last(t)), lambda i: F.substr(t, i, F.lit(n)))))

    # A second parameter of the function would be the place in the array.
    tagged = lambda n: F.transform(grams(n), lambda g: F.concat(F.lit(f"{n}:"), g))
    return F.concat(*map(tagged, sizes))


def word_grams(text: Column) -> Column:
    """Words of two characters and more, and pairs of neighbours among them."""
    def of(words: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, 2), " "))
        return F.concat(words, F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<string>")))

    # An array of one element names what is used for every pair.
    return F.flatten(F.transform(F.array(F.filter(tokens(text), lambda t: F.length(t) >= 2)), of))


def term_weights(records: DataFrame, terms: Column, vocabulary: int | None = None) -> DataFrame:
    """``(country, side, entity_id, term, w, df)`` with one-off sublinear tf-idf, unit length for each record.

    ``records`` has ``side``, ``entity_id`` and ``country``. Statistics are
    those of the country, over both sides. With ``vocabulary`` only a country's most
    frequent terms count, ties by term. Records without terms give no row.
    """
    tf = records.select("country", "side", "entity_id", F.explode(terms).alias("term")).groupBy("country", "side", "entity_id", "term").agg(F.count("*").alias("tf"))
    stats = tf.groupBy("country", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    if vocabulary is not None:
        by_total = Window.partitionBy("country").orderBy(F.desc("total"), "term")
        stats = stats.withColumn("at", F.row_number().over(by_total)).filter(F.col("at") <= vocabulary).drop("at")
    sizes = records.groupBy("country").agg(F.count("*").alias("n"))
    idf = F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0
    raw = tf.join(stats, ["country", "term"]).join(sizes, "country").select("country", "side", "entity_id", "term", "df", ((1.0 + F.log(F.col("tf").cast("double"))) * idf).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("side", "entity_id")))
    return raw.select("country", "side", "entity_id", "term", (F.col("w") / norm).alias("w"), "df")


def both_sides(left: DataFrame, right: DataFrame, text: Column) -> DataFrame:
    """``(side, entity_id, country, text)`` of both sides; terms are weighted within a country as its labels mean it."""
    cols = ("entity_id", F.col("country_key").alias("country"), text.alias("text"))
    sides = left.select(F.lit(1).alias("side"), *cols).unionByName(right.select(F.lit(2).alias("side"), *cols))
    # Texts are placed by record while they are small: counting a record's terms then needs no shuffle of terms.
    # The number is given, since texts small enough to be merged into one partition have many terms.
    return cut(sides, "texts").repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), "entity_id")


def best(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best candidates of each ``s1_id``, ties by smaller ``cand_id``; only positive scores."""
    order = Window.partitionBy("s1_id").orderBy(F.desc("score"), "cand_id")
    return scores.filter("score > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


@dataclass
class Postings:
    """Terms of records in order, ``rows`` of them: entry ``i`` says that record ``row[i]`` has term ``code[i]`` with weight ``w[i]``."""

    rows: int
    row: np.ndarray
    code: np.ndarray
    w: np.ndarray


def rough_scores(left: Postings, right: Postings, terms: int) -> np.ndarray:
    """Sums of products of weights over shared ones of ``terms`` terms, left times right records, in single precision; 0 only where none is shared.

    Weights are positive, so a sum is off by no more than its :func:`rough_error`.
    """
    rows, columns = left.rows, right.rows
    counts = np.bincount(right.code, minlength=terms)
    products = np.bincount(left.code, minlength=terms) * counts
    hot = products > DENSE * rows * columns
    dense = np.flatnonzero(hot)
    place = np.full(terms, -1)
    place[dense] = np.arange(len(dense))

    def matrix(side: Postings) -> np.ndarray:
        own = hot[side.code]
        out = np.zeros((side.rows, len(dense)), np.float32)
        out[side.row[own], place[side.code[own]]] = side.w[own]
        return out

    out = matrix(left) @ matrix(right).T if len(dense) else np.zeros((rows, columns), np.float32)
    order = np.argsort(right.code, kind="stable")
    column, weight, starts = right.row[order], right.w[order], np.cumsum(counts) - counts
    rest = ~hot[left.code] & (counts[left.code] > 0)
    row, code, w = left.row[rest], left.code[rest], left.w[rest]
    each = counts[code]
    ends = np.cumsum(each)
    first = 0
    while first < len(code):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PRODUCTS)))
        n = each[first:last]
        at = np.repeat(starts[code[first:last]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        low, high = row[first], row[last - 1] + 1
        cells = np.repeat((row[first:last] - low) * columns, n) + column[at]
        out[low:high] += np.bincount(cells, np.repeat(w[first:last], n) * weight[at], (high - low) * columns).reshape(-1, columns)
        first = last
    return out


def rough_error(left: Postings) -> float:
    """Share of a sum of :func:`rough_scores` by which it is off at most: half a last digit for each weight, product and addition, twice."""
    return (np.bincount(left.row, minlength=1).max(initial=0) + 8) * 2.0**-23


def pair_scores(left: Postings, right: Postings, terms: int, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sums of products of weights over shared terms, of left records ``r`` and right records ``c``, in double precision."""
    ends = np.searchsorted(right.row, np.arange(right.rows + 1))
    keys = left.row * terms + left.code
    out = np.zeros(len(r))
    each = np.diff(ends)[c]
    sums = np.cumsum(each)
    first = 0
    while first < len(r) and len(keys):
        last = max(first + 1, int(np.searchsorted(sums, (sums[first - 1] if first else 0) + PRODUCTS)))
        n = each[first:last]
        at = np.repeat(ends[c[first:last]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        wanted = np.repeat(r[first:last] * terms, n) + right.code[at]
        found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        out[first:last] = np.bincount(np.repeat(np.arange(last - first), n), np.where(keys[found] == wanted, left.w[found] * right.w[at], 0.0), last - first)
        first = last
    return out


BLOCK = "country string, side int, block string, n double, avg double, ids array<string>, terms array<string>, df array<int>, ends binary, codes binary, tf binary, by_row binary"
_ARROW = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32())}
BLOCK_SCHEMA = pa.schema([(name, _ARROW[kind]) for name, kind in (x.split() for x in BLOCK.split(", "))])


def packed_blocks(country: str, side: int, name: str, n: float, avg: float, ids: list[str], row: np.ndarray, code: np.ndarray, tf: np.ndarray, by_row: np.ndarray, terms: pa.Array, df: np.ndarray, size: int) -> Iterator[dict]:
    """Rows of :data:`BLOCK`, of at most ``size`` records each; postings are in order of their rows and of the terms in each.

    Terms are named once in a block; a posting is the step to its term from the one before, and its count.
    """
    for first in range(0, len(ids), size):
        own = ids[first : first + size]
        ends = np.searchsorted(row, np.arange(first, first + len(own) + 1))
        lo, hi = ends[0], ends[-1]
        used, local = np.unique(code[lo:hi], return_inverse=True)
        steps = np.diff(local, prepend=0)
        heads = (ends[:-1] - lo)[ends[:-1] < ends[1:]]
        steps[heads] = local[heads]
        kind = lambda x: "<f8" if x.dtype.kind == "f" else "<u2" if x.max(initial=0) < 65536 else "<u4"
        narrow = lambda x: kind(x)[-1:].encode() + zlib.compress(x.astype(kind(x)).tobytes(), 1)
        yield {
            "country": country, "side": side, "block": f"{name}-{first}", "n": n, "avg": avg, "ids": own, "terms": terms.take(pa.array(used)), "df": df[used].astype(np.int32),
            "ends": (ends - lo).astype("<i4").tobytes(), "codes": narrow(steps), "tf": narrow(tf[lo:hi]), "by_row": zlib.compress(by_row[first : first + len(own)].astype("<f8").tobytes(), 1),
        }


def block_batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """A batch for each of :func:`packed_blocks`."""
    listed = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x, kind.value_type))
    for x in rows:
        yield pa.RecordBatch.from_arrays([listed(x[f.name], f.type) if pa.types.is_list(f.type) else pa.array([x[f.name]], f.type) for f in BLOCK_SCHEMA], schema=BLOCK_SCHEMA)


#: Weights of postings by side, counts in the record and in the country, the country's two figures and those of the record.
Weigh = Callable[[int, np.ndarray, np.ndarray, float, float, np.ndarray], np.ndarray]


def unpacked_block(block: dict, side: int, weigh: Weigh) -> Postings:
    """Weighted postings of a row of :data:`BLOCK`, terms numbered in it."""
    load = lambda x: np.frombuffer(zlib.decompress(x[1:]), {b"2": "<u2", b"4": "<u4", b"8": "<f8"}[x[:1]])
    ends = np.frombuffer(block["ends"], "<i4").astype(np.int64)
    rows = len(ends) - 1
    sizes = np.diff(ends)
    row = np.repeat(np.arange(rows), sizes)
    code = np.cumsum(load(block["codes"]).astype(np.int64))
    # Steps begin anew with every record.
    before = np.r_[0, code][ends[:-1]]
    code = code - np.repeat(before, sizes)
    by_row = np.frombuffer(zlib.decompress(block["by_row"]), "<f8").reshape(rows, -1)
    of_space = by_row[row, np.minimum(block["space"][code], by_row.shape[1] - 1)] if by_row.shape[1] else np.empty(0)
    return Postings(rows, row, code, weigh(side, load(block["tf"]).astype(float), block["df"][code].astype(float), block["n"], block["avg"], of_space))


def best_of_rows(row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each row, in order; ties by smaller id."""
    order = np.lexsort((ids, -score, row))
    own = row[order]
    return order[np.arange(len(own)) - np.searchsorted(own, own) < k]


def top_by_blocks(blocks: DataFrame, k: int, weigh: Weigh) -> DataFrame:
    """``(s1_id, cand_id, score, rank)``: exact best ``k`` of each left record over all rows of :data:`BLOCK` of its country.

    Every left block meets every right one by reading it again from the table of
    blocks, in a product of partitions without a shuffle; a task keeps the best of a left block while right blocks pass.
    """
    columns = ("block", "n", "avg", "ids", "terms", "df", "ends", "codes", "tf", "by_row")
    sides = [blocks.filter(F.col("side") == side).select("country", F.struct(*columns).alias(name)) for side, name in ((1, "l"), (2, "r"))]
    counts = [max(1, d.count()) for d in sides]
    parts = max(min(counts[1], RIGHT_PARTS), -(-counts[1] // RIGHT_BLOCKS))
    pairs = sides[0].repartition(counts[0]).join(sides[1].coalesce(parts).hint("shuffle_replicate_nl"), "country").select("l", "r")

    def opened(x: pa.StructArray, i: int, side: int) -> tuple[dict, Postings]:
        block = {name: x.field(name)[i] for name in columns}
        block = {name: v.values if name in ("ids", "terms", "df") else v.as_py() for name, v in block.items()}
        # The first letter of a term names its kind.
        block["space"] = (pc.utf8_slice_codeunits(block["terms"], 0, 1).to_numpy(zero_copy_only=False) == "w").astype(np.int64)
        block["df"] = block["df"].to_numpy()
        return block, unpacked_block(block, side, weigh)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[dict, Postings] | None = None
        pool: tuple[np.ndarray, np.ndarray, np.ndarray] = (np.array([], np.int64), np.array([]), np.array([], object))

        def out() -> pa.RecordBatch:
            kept = best_of_rows(*pool, k)
            r, s, c = (x[kept] for x in pool)
            rows, ends = np.unique(r, return_index=True)
            ends = pa.array(np.r_[ends, len(r)], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, t)) for x, t in ((c.tolist(), pa.string()), (s, pa.float64()))]
            return pa.RecordBatch.from_arrays([held[0]["ids"].take(pa.array(rows)), *lists], names=["s1_id", "cand_ids", "scores"])

        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column("l").field("block")[i].as_py()
                if held is None or held[0]["block"] != name:
                    if held is not None:
                        yield out()
                    held, pool = opened(batch.column("l"), i, 1), (np.array([], np.int64), np.array([]), np.array([], object))
                    least = np.zeros(held[1].rows)
                (mine, left), (other, right) = held, opened(batch.column("r"), i, 2)
                # Right terms that the left block lacks get the number after its own.
                same = pc.fill_null(pc.index_in(other["terms"], value_set=mine["terms"]), len(mine["terms"])).to_numpy()
                code = same[right.code].astype(np.int64)
                known = code < len(mine["terms"])
                right = Postings(right.rows, right.row[known], code[known], right.w[known])
                rough, error = rough_scores(left, right, len(mine["terms"])), rough_error(left)
                if right.rows > k:
                    low = np.flatnonzero(least == 0)
                    least[low] = np.partition(rough[low], -k, axis=1)[:, -k] * (1 - error) if len(low) else 0
                # Only pairs that may be among the best are summed in double precision.
                floor = np.maximum((least - 1e-8) * (1 - 2 * error), np.finfo(np.float32).tiny).astype(np.float32)
                r, c = np.nonzero(rough >= floor[:, None])
                found = np.round(pair_scores(left, right, len(mine["terms"]), r, c), 9)
                kept = found >= least[r] - 1e-8
                r, c, found = r[kept], c[kept], found[kept]
                pool = tuple(np.concatenate(x) for x in zip(pool, (r, found, np.array(other["ids"].to_pylist(), object)[c]), strict=True))
                order = np.lexsort((-pool[1], pool[0]))
                own, sorted_scores = pool[0][order], pool[1][order]
                starts = np.searchsorted(own, np.arange(left.rows + 1))
                full = np.flatnonzero(np.diff(starts) >= k)
                least[full] = sorted_scores[starts[full] + k - 1]
                pool = tuple(x[order[sorted_scores >= least[own]]] for x in pool)
                if len(pool[0]) > 2 * left.rows * k:
                    kept = best_of_rows(*pool, k)
                    pool = tuple(x[kept] for x in pool)
        if held is not None:
            yield out()

    # Lists go to the left record's task as they are.
    found = pairs.mapInArrow(score, "s1_id string, cand_ids array<string>, scores array<double>").repartition("s1_id")
    each = found.select("s1_id", F.explode(F.arrays_zip("cand_ids", "scores")).alias("x")).select("s1_id", F.col("x.cand_ids").alias("cand_id"), F.col("x.scores").alias("score"))
    return best(each, k)


def top_by_terms(weights: DataFrame, k: int, left_block: int = LEFT_BLOCK, right_block: int = RIGHT_BLOCK) -> DataFrame:
    """:func:`top_by_blocks` by the sum of products over all shared terms of ``weights (country, side, entity_id, term, w)``."""
    listed = weights.groupBy("country", "side", "entity_id").agg(F.collect_list("term").alias("terms"), F.collect_list("w").alias("ws"))
    sizes = cut(weights.groupBy("country", "side").agg(F.ceil(F.count_distinct("entity_id") / CHUNK).alias("chunks")), "sizes")
    placed = listed.join(sizes, ["country", "side"]).withColumn("chunk", F.pmod(F.xxhash64("entity_id"), "chunks"))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        country, side, chunk = (x.as_py() for x in key)
        row = np.repeat(np.arange(len(table)), pc.list_value_length(table["terms"]).to_numpy())
        terms = pc.dictionary_encode(pc.list_flatten(table["terms"])).combine_chunks()
        code, w = terms.indices.to_numpy().astype(np.int64), pc.list_flatten(table["ws"]).to_numpy()
        order = np.lexsort((code, row))
        blocks = packed_blocks(country, side, f"{chunk}", 0.0, 0.0, table["entity_id"].to_pylist(), row[order], code[order], w[order], np.empty((len(table), 0)), terms.dictionary, np.zeros(len(terms.dictionary)), left_block if side == 1 else right_block)
        return pa.Table.from_batches(block_batches(blocks), schema=BLOCK_SCHEMA)

    blocks = cut(placed.groupBy("country", "side", "chunk").applyInArrow(pack, BLOCK), "blocks")
    return top_by_blocks(blocks, k, lambda side, tf, df, n, avg, by_row: tf)


@dataclass(frozen=True)
class Terms:
    """Kinds of terms of a text: character n-grams inside words of ``sizes``, and with ``words`` words and their pairs; ``c`` or ``w`` stands before a term.

    In Python for what :func:`char_wb_grams` and :func:`word_grams` are as columns: terms are many times as large
    as their texts, so no more than their counts leaves a task.
    """

    sizes: tuple[int, ...]
    words: bool

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """``(row, code, tf, terms)`` of texts, in order of rows and codes; lines of a text are texts of one record."""
        index: dict[str, int] = {}
        number = lambda term: index.setdefault(term, len(index))
        grams: dict[str, list[int]] = {}
        parts = [(np.array([], np.int32),) * 3]
        for first in range(0, len(texts), RIGHT_BLOCK):
            codes: list[int] = []
            sizes = []
            for text in texts[first : first + RIGHT_BLOCK]:
                start = len(codes)
                for line in text.split("\n"):
                    words = [w for w in line.split(" ") if w]
                    for w in words:
                        if w not in grams:
                            p = f" {w} "
                            grams[w] = [number(f"c{n}:{p[i : i + n]}") for n in self.sizes for i in range(max(1, len(p) - n + 1))]
                        codes += grams[w]
                    if self.words:
                        words = [w for w in words if len(w) >= 2]
                        codes += [number(f"w{w}") for w in words]
                        codes += [number(f"w{x} {y}") for x, y in zip(words, words[1:], strict=False)]
                sizes.append(len(codes) - start)
            width = max(1, len(index))
            keys, tf = np.unique(np.repeat(np.arange(len(sizes)), sizes) * width + np.array(codes, np.int64), return_counts=True)
            parts.append(tuple(x.astype(np.int32) for x in (first + keys // width, keys % width, tf)))
        return *(np.concatenate(x) for x in zip(*parts, strict=True)), list(index)

    def counted(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``(country, bucket, terms, counts)`` of rows ``(country, side, text)``, a record each: terms of a bucket in lines, and for each how many left and
        right records have it, how often it stands in all and in right ones. Packed, since most terms are rare and the counts of them small."""

        def counts(held: list[pa.RecordBatch]) -> Iterator[tuple]:
            table = pa.Table.from_batches(held).combine_chunks()
            country = pc.dictionary_encode(table["country"]).combine_chunks()
            row, code, tf, terms = self.of(table["text"].to_pylist())
            width = max(1, len(terms))
            keys, at = np.unique(country.indices.to_numpy().astype(np.int64)[row] * width + code, return_inverse=True)
            right = (table["side"].to_numpy() == 2)[row]
            sums = np.stack([np.bincount(at, x, len(keys)) for x in (~right, right, tf, tf * right)]).astype("<i8")
            which, code = np.divmod(keys, width)
            bucket = np.array([zlib.crc32(x.encode()) % TERM_BUCKETS for x in terms], np.int64)[code]
            order = np.lexsort((bucket, which))
            groups, starts = np.unique(which[order] * TERM_BUCKETS + bucket[order], return_index=True)
            for group, own in zip(groups.tolist(), np.split(order, starts[1:]), strict=True):
                own = np.array(sorted(own.tolist(), key=lambda i: terms[code[i]]))
                text = "\n".join([terms[i] for i in code[own]])
                yield country.dictionary[group // TERM_BUCKETS].as_py(), group % TERM_BUCKETS, zlib.compress(text.encode(), 6), zlib.compress(sums[:, own].tobytes(), 6)

        def batch(rows: Iterator[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["country", "bucket", "terms", "counts"])

        held: list[pa.RecordBatch] = []
        for part in batches:
            held.append(part)
            if sum(x.num_rows for x in held) >= CHUNK // 2:
                yield batch(counts(held))
                held = []
        if held:
            yield batch(counts(held))


def term_counts(texts: DataFrame, terms: Terms, most: dict[str, int | None]) -> DataFrame:
    """``(country, term, left_df, right_df, total, right_total)``; terms of a kind that are surely not among the ``most`` frequent of a country may be left out."""

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        parts = [zlib.decompress(x).decode().split("\n") for x in table["terms"].to_pylist()]
        found = pa.array([x for part in parts for x in part], pa.string()).dictionary_encode()
        sums = np.concatenate([np.frombuffer(zlib.decompress(x), "<i8").reshape(4, -1) for x in table["counts"].to_pylist()], axis=1)
        at = found.indices.to_numpy()
        sums = np.stack([np.bincount(at, x, len(found.dictionary)).astype(np.int64) for x in sums])
        kinds = pc.utf8_slice_codeunits(found.dictionary, 0, 1).to_numpy(zero_copy_only=False)
        kept = np.ones(len(kinds), bool)
        for kind, n in most.items():
            own = kinds == kind
            if n is not None and own.sum() > n:
                kept[own] = sums[2][own] >= -np.partition(-sums[2][own], n - 1)[n - 1]
        return pa.table([pa.repeat(key[0], int(kept.sum())), found.dictionary.filter(pa.array(kept)), *map(pa.array, sums[:, kept])], names=["country", "term", *COUNTS])

    packed = texts.select("country", "side", "text").mapInArrow(terms.counted, "country string, bucket int, terms binary, counts binary")
    return packed.groupBy("country", "bucket").applyInArrow(merged, "country string, term string" + "".join(f", {c} bigint" for c in COUNTS))


def record_texts(left: DataFrame, right: DataFrame, text: Column) -> DataFrame:
    """``(side, entity_id, country, text, rows, homes)``: a row for each record and country, its texts in lines, how many they are and how many countries the record has."""
    cols = ("entity_id", F.col("country_key").alias("country"), text.alias("text"))
    sides = left.select(F.lit(1).alias("side"), *cols).unionByName(right.select(F.lit(2).alias("side"), *cols))
    own = sides.groupBy("side", "entity_id").agg(F.sort_array(F.collect_list(F.struct("country", F.coalesce("text", F.lit("")).alias("text")))).alias("x"))
    each = own.select("side", "entity_id", "x", F.explode(F.array_distinct("x.country")).alias("country"), F.size(F.array_distinct("x.country")).alias("homes"))
    mine = F.transform(F.filter("x", lambda y: y.country == F.col("country")), lambda y: y.text)
    return cut(each.select("side", "entity_id", "country", F.array_join(mine, "\n").alias("text"), F.size(mine).alias("rows"), "homes"), "texts")


def top_by_texts(texts: DataFrame, k: int, terms: Terms, vocabulary: Callable[[DataFrame], DataFrame], figures: Callable[[DataFrame], DataFrame], by_row: Callable, weigh: Weigh, norms: Callable[[DataFrame, DataFrame, DataFrame], DataFrame] | None = None, asked: DataFrame | None = None, most: dict[str, int | None] | None = None, since: int | None = None) -> DataFrame:
    """:func:`top_by_blocks` of :func:`record_texts`; only texts, counts of terms and packed blocks are shuffled or written.

    ``vocabulary`` chooses ``(country, term, df, used)`` from :func:`term_counts` of the ``most`` frequent ones, ``figures`` gives ``(country, n, avg)``;
    ``by_row(row, space, tf, df, n, avg, rows)`` gives what ``weigh`` needs of each record. With ``norms`` records of several
    countries have that figure from rows of all of them. Terms not ``used`` count in it, but are not matched.
    With ``asked (entity_id)`` other left records only count. Tables written after the mark ``since`` are removed once blocks are.
    """
    counts = cut(term_counts(texts, terms, most or {}), "terms")
    stats = cut(figures(counts), "figures")
    known = cut(vocabulary(counts), "vocabulary")
    rows = texts if asked is None else texts.join(asked.select("entity_id", F.lit(1).alias("side")), ["entity_id", "side"], "left_semi").unionByName(texts.filter("side = 2"))
    strays = texts.filter("homes > 1")
    if norms is not None and not strays.isEmpty():
        rows = rows.join(cut(norms(strays, known, stats), "norms"), ["side", "entity_id"], "left")
    else:
        rows = rows.withColumn("whole", F.lit(None).cast("array<double>"))
    sizes = cut(rows.groupBy("country", "side").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")).join(stats, "country"), "sizes")
    placed = rows.join(sizes, ["country", "side"]).select("country", "side", F.pmod(F.xxhash64("entity_id"), "chunks").alias("chunk"), "entity_id", "text", "whole", "n", "avg")
    words = known.join(sizes, "country").select("country", "side", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), "term", "df", "used")

    def pack(key: tuple, own: pa.Table, words: pa.Table) -> pa.Table:
        country, side, chunk = (x.as_py() for x in key)
        size = LEFT_BLOCK if side == 1 else RIGHT_BLOCK

        def blocks() -> Iterator[dict]:
            names = words["term"].combine_chunks()
            df, used = words["df"].to_numpy().astype(float), words["used"].to_numpy(zero_copy_only=False)
            space = (pc.utf8_slice_codeunits(names, 0, 1).to_numpy(zero_copy_only=False) == "w").astype(np.int64)
            n, avg = own["n"][0].as_py(), own["avg"][0].as_py()
            for first in range(0, len(own), size):
                some = own.slice(first, size)
                row, code, tf, found = terms.of(some["text"].to_pylist())
                at = pc.fill_null(pc.index_in(pa.array(found, pa.string()), value_set=names), -1).to_numpy(zero_copy_only=False).astype(np.int64)[code]
                row, code, tf = row[at >= 0], at[at >= 0], tf[at >= 0]
                figure = by_row(row, space[code], tf, df[code], n, avg, len(some))
                for i in np.flatnonzero(some["whole"].is_valid().to_numpy()):
                    figure[i] = some["whole"][int(i)].as_py()
                order = np.lexsort((code, row))
                order = order[used[code[order]]]
                yield from packed_blocks(country, side, f"{chunk}-{first}", n, avg, some["entity_id"].to_pylist(), row[order], code[order], tf[order], figure, names, df, size)

        return pa.Table.from_batches(block_batches(blocks() if len(own) and len(words) else iter(())), schema=BLOCK_SCHEMA)

    keys = ("country", "side", "chunk")
    return top_by_blocks(cut(placed.groupBy(*keys).cogroup(words.groupBy(*keys)).applyInArrow(pack, BLOCK), "blocks", since=since), k, weigh)


def _sublinear(tf: np.ndarray, df: np.ndarray, n: float) -> np.ndarray:
    return (1.0 + np.log(tf)) * (np.log((1.0 + n) / (1.0 + df)) + 1.0)


def tfidf_candidates(left: DataFrame, right: DataFrame, text: Column, k: int = 20, char_terms: int | None = 200_000, word_terms: int | None = 100_000, max_postings: int | None = None, asked: DataFrame | None = None) -> DataFrame:
    """``(s1_id, cand_id, score, rank)`` by the sum of two cosines, over character and word n-grams.

    All terms are matched, by :func:`top_by_blocks`; with ``max_postings`` terms found
    in more records of a country keep their part in the lengths but are not matched.
    Scores are rounded to nine digits before they are ranked, so that the order of
    summation can't decide a tie. With ``asked`` only these left records get candidates; statistics are those of all.
    """
    since = mark()
    texts = record_texts(left, right, text)

    def vocabulary(counts: DataFrame) -> DataFrame:
        """The most frequent terms of each kind, ties by term."""
        kinds = []
        for kind, most in (("c", char_terms), ("w", word_terms)):
            own = counts.filter(F.col("term").startswith(kind))
            if most is not None:
                # Whole classes of equal totals are counted; only the terms of the last one are put in order.
                classes = own.groupBy("country", "total").agg(F.count("*").alias("terms"))
                up_to = F.sum("terms").over(Window.partitionBy("country").orderBy(F.desc("total")))
                classes = cut(classes.withColumn("up_to", up_to).filter(F.col("up_to") - F.col("terms") < most), "classes")
                own = own.join(classes, ["country", "total"])
                whole = own.filter(F.col("up_to") <= most)
                by_term = Window.partitionBy("country").orderBy("term")
                last = own.filter(F.col("up_to") > most).withColumn("at", F.row_number().over(by_term)).filter(F.col("at") <= F.col("terms") - (F.col("up_to") - most))
                own = whole.unionByName(last.drop("at"))
            kinds.append(own)
        df = F.col("left_df") + F.col("right_df")
        used = (F.col("left_df") > 0) & (F.col("right_df") > 0) & (F.lit(True) if max_postings is None else df <= max_postings)
        return reduce(DataFrame.unionByName, [d.select("country", "term", df.alias("df"), used.alias("used")) for d in kinds])

    def lengths(row, space, tf, df, n, avg, rows):
        out = np.stack([np.bincount(row[space == x], _sublinear(tf, df, n)[space == x] ** 2, rows) for x in (0, 1)], axis=1)
        return np.sqrt(out)

    def norms(strays: DataFrame, known: DataFrame, stats: DataFrame) -> DataFrame:
        """Lengths over all countries of a record."""
        lines = strays.select("side", "entity_id", "country", F.explode(F.split("text", "\n")).alias("text"))
        tagged = [F.transform(grams, tag) for grams, tag in ((char_wb_grams(F.col("text")), lambda g: F.concat(F.lit("c"), g)), (word_grams(F.col("text")), lambda g: F.concat(F.lit("w"), g)))]
        tf = lines.select("side", "entity_id", "country", F.explode(F.concat(*tagged)).alias("term")).groupBy("side", "entity_id", "country", "term").agg(F.count("*").alias("tf"))
        w = (1.0 + F.log("tf")) * (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0)
        of = lambda kind: F.sqrt(F.sum(F.when(F.col("term").startswith(kind), w * w).otherwise(0.0)))
        return tf.join(known, ["country", "term"]).join(stats, "country").groupBy("side", "entity_id").agg(F.array(of("c"), of("w")).alias("whole"))

    figures = lambda counts: texts.groupBy("country").agg(F.sum("rows").cast("double").alias("n"), F.lit(0.0).alias("avg"))
    return top_by_texts(texts, k, Terms((2, 3), True), vocabulary, figures, lengths, lambda side, tf, df, n, avg, length: _sublinear(tf, df, n) / length, norms, asked, {"c": char_terms, "w": word_terms}, since)


def pair_cosines(pairs: DataFrame, left: DataFrame, right: DataFrame, text: Column, since: int | None = None) -> DataFrame:
    """``(s1_id, cand_id, cosine)`` of word n-gram weights for given pairs; 0 where nothing is shared or the countries differ.

    Terms travel as digests of eight bytes, once for each chunk of records: parts of all terms count and number them and answer
    each chunk in the order it asked. Vectors then hold numbers of terms that both sides have, and a left record's vector
    is sent once to each part of the right records, with the list of its candidates there.
    Tables written after the mark ``since`` are removed once vectors are; ``pairs`` may not read them.
    """
    cols = ("entity_id", F.col("country_key").alias("country"), F.coalesce(text, F.lit("")).alias("text"))
    sides = left.select(F.lit(1).alias("side"), *cols).unionByName(right.select(F.lit(2).alias("side"), *cols))
    records = right.count()
    chunks, parts = max(1, -(-(left.count() + records) // CHUNK)), max(1, -(-records // PAIR_PART))
    part = F.pmod(F.xxhash64("cand_id"), F.lit(parts)).cast("int")
    place = F.pmod(F.xxhash64("side", "entity_id"), F.lit(chunks)).cast("int").alias("chunk")
    sizes = cut(sides.groupBy("country").agg(F.count("*").cast("double").alias("n")), "sizes")
    # Texts are shuffled once, for asking and for the answers; terms are made behind the shuffle.
    rows = sides.join(sizes, "country").select("side", "entity_id", "country", "text", "n", place).repartition(chunks, "chunk")
    own = rows.groupBy("chunk", "side", "entity_id", "country", "n").agg(F.flatten(F.collect_list(F.transform(word_grams(F.col("text")), lambda t: F.xxhash64("country", t)))).alias("terms"))
    asking = own.select("chunk", "side", "terms")

    def listed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        terms = table["terms"].combine_chunks()
        return np.repeat(np.arange(len(table)), pc.list_value_length(terms).to_numpy()), pc.list_flatten(terms).to_numpy().astype(np.int64)

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        """The distinct terms of a chunk in parts, in order, and how many of its left and right records have each."""
        row, terms = listed(table)
        known, code = np.unique(terms, return_inverse=True)
        cells = np.unique(row * max(1, len(known)) + code)
        right_row = (table["side"].to_numpy() == 2)[cells // max(1, len(known))]
        counts = np.stack([np.bincount(cells % max(1, len(known)), x, len(known)) for x in (~right_row, right_row)]).astype("<i4")
        ends = np.searchsorted(known % TERM_BUCKETS, np.arange(TERM_BUCKETS + 1), sorter=(order := np.argsort(known % TERM_BUCKETS, kind="stable")))
        owns = [(i, order[x:y]) for i, (x, y) in enumerate(itertools.pairwise(ends)) if y > x]
        return pa.table([
            pa.array([key[0].as_py()] * len(owns), pa.int32()), pa.array([i for i, _ in owns], pa.int32()), pa.array([known[x].astype("<i8").tobytes() for _, x in owns], pa.binary()),
            pa.array([zlib.compress(counts[:, x].tobytes(), 1) for _, x in owns], pa.binary()),
        ], names=["chunk", "bucket", "terms", "counts"])

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        """For each chunk, in how many records its terms are, and their numbers; those that one side lacks have none."""
        terms = [np.frombuffer(x, "<i8") for x in table["terms"].to_pylist()]
        known, code = np.unique(np.concatenate(terms), return_inverse=True)
        counts = np.concatenate([np.frombuffer(zlib.decompress(x), "<i4").reshape(2, -1) for x in table["counts"].to_pylist()], axis=1)
        sums = np.stack([np.bincount(code, x, len(known)) for x in counts]).astype(np.int64)
        shared = (sums > 0).all(axis=0)
        numbers = np.where(shared, (np.cumsum(shared) - 1) * TERM_BUCKETS + key[0].as_py(), -1)
        split = np.cumsum([len(x) for x in terms])[:-1]
        answers = [zlib.compress(np.stack(x).astype("<i8").tobytes(), 1) for x in zip(np.split(sums.sum(axis=0)[code], split), np.split(numbers[code], split), strict=True)]
        return pa.table([table["chunk"], table["bucket"], pa.array(answers, pa.binary())], names=["chunk", "bucket", "answer"])

    def weigh(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        """Vectors of a chunk: numbers of terms, counts for left records, weights times inverse frequency for right ones, and the length."""
        row, terms = listed(table)
        known, code = np.unique(terms, return_inverse=True)
        found = np.zeros((2, len(known)), np.int64)
        bucket = known % TERM_BUCKETS
        order = np.argsort(bucket, kind="stable")
        for i, x in zip(answers["bucket"].to_pylist(), answers["answer"].to_pylist(), strict=True):
            found[:, order[np.searchsorted(bucket, i, sorter=order) : np.searchsorted(bucket, i, "right", sorter=order)]] = np.frombuffer(zlib.decompress(x), "<i8").reshape(2, -1)
        cells, tf = np.unique(row * max(1, len(known)) + code, return_counts=True)
        row, code = np.divmod(cells, max(1, len(known)))
        idf = np.log((1.0 + table["n"].to_numpy()[row]) / (1.0 + found[0][code])) + 1.0
        tf = 1.0 + np.log(tf)
        # A record's rows in several countries are one vector.
        names = pa.array([f"{x}{y}" for x, y in zip(table["side"].to_pylist(), table["entity_id"].to_pylist(), strict=True)]).dictionary_encode()
        record = names.indices.to_numpy()[row]
        length = np.sqrt(np.bincount(record, (tf * idf) ** 2, len(names.dictionary)))
        used = found[1][code] >= 0
        order = np.flatnonzero(used)[np.argsort(record[used], kind="stable")]
        record, tf, idf, number = record[order], tf[order], idf[order], found[1][code[order]]
        ends = np.searchsorted(record, np.arange(len(names.dictionary) + 1))
        ids = names.dictionary.to_pylist()
        weights = np.where(np.array([x[0] == "1" for x in ids], bool)[record], tf, tf * idf * idf) / length[record]
        numbers, weights = (pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in (number, weights))
        return pa.table([pa.array([int(x[0]) for x in ids], pa.int32()), pa.array([x[1:] for x in ids], pa.string()), numbers, weights], names=["side", "entity_id", "numbers", "weights"])

    asks = asking.groupBy("chunk").applyInArrow(ask, "chunk int, bucket int, terms binary, counts binary")
    answers = asks.groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, answer binary")
    kind = "side int, entity_id string, numbers array<bigint>, weights array<double>"
    vectors = cut(own.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(weigh, kind), "vectors", since=since)

    def score(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
        """Cosines of lists of candidates in a part."""
        ids, cands = asked["s1_id"].combine_chunks(), asked["cands"].combine_chunks()
        flat = pc.list_flatten(cands)
        r = np.repeat(np.arange(len(ids)), pc.list_value_length(cands).to_numpy())
        c = pc.fill_null(pc.index_in(flat, value_set=known["entity_id"].combine_chunks()), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        out, met = np.zeros(len(r)), c >= 0

        def postings(table: pa.Table, numbers: np.ndarray) -> Postings:
            lists = table["numbers"].combine_chunks()
            return Postings(len(table), np.repeat(np.arange(len(table)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)), numbers, pc.list_flatten(table["weights"].combine_chunks()).to_numpy())

        sides = [pc.list_flatten(t["numbers"].combine_chunks()).to_numpy() for t in (asked, known)]
        terms, code = np.unique(np.concatenate(sides), return_inverse=True)
        a, b = (postings(t, x) for t, x in zip((asked, known), np.split(code, [len(sides[0])]), strict=True))
        order = np.lexsort((a.code, a.row))
        a = Postings(a.rows, a.row[order], a.code[order], a.w[order])
        out[met] = pair_scores(a, b, max(1, len(terms)), r[met], c[met])
        return pa.table([ids.take(pa.array(r)), flat, pa.array(out)], names=["s1_id", "cand_id", "cosine"])

    mine = vectors.filter("side = 1").select(F.col("entity_id").alias("s1_id"), "numbers", "weights")
    asked = pairs.select("s1_id", "cand_id").join(mine, "s1_id", "left").groupBy("s1_id", part.alias("part"))
    asked = asked.agg(F.first("numbers").alias("numbers"), F.first("weights").alias("weights"), F.collect_set("cand_id").alias("cands"))
    known = vectors.filter("side = 2").select(F.col("entity_id").alias("cand_id"), "numbers", "weights").select(part.alias("part"), F.col("cand_id").alias("entity_id"), "numbers", "weights")
    return asked.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(score, "s1_id string, cand_id string, cosine double")


def bm25_candidates(left: DataFrame, right: DataFrame, text: Column, k: int = 20, k1: float = 1.2, b: float = 0.75, max_postings: int | None = None) -> DataFrame:
    """``(s1_id, cand_id, score, rank)`` by BM25 over character 3-grams; each distinct gram of the left text asks once."""
    since = mark()
    texts = record_texts(left, right, text)

    def vocabulary(counts: DataFrame) -> DataFrame:
        used = (F.col("left_df") > 0) & (F.lit(True) if max_postings is None else F.col("right_df") <= max_postings)
        return counts.filter("right_df > 0").select("country", "term", F.col("right_df").alias("df"), used.alias("used"))

    def figures(counts: DataFrame) -> DataFrame:
        docs = texts.filter((F.col("side") == 2) & (F.trim(F.translate("text", "\n", " ")) != "")).groupBy("country").agg(F.count("*").cast("double").alias("n"))
        return docs.join(counts.groupBy("country").agg(F.sum("right_total").alias("total")), "country").select("country", "n", (F.col("total") / F.col("n")).alias("avg"))

    def lengths(row, space, tf, df, n, avg, rows):
        return np.bincount(row, tf, rows).reshape(-1, 1)

    def weigh(side, tf, df, n, avg, length):
        if side == 1:
            return np.ones(len(tf))
        return np.log(1.0 + (n - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / avg))

    return top_by_texts(texts, k, Terms((3,), False), vocabulary, figures, lengths, weigh, since=since)


def cosine_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = 256) -> DataFrame:
    """``(query_id, vec_id, score, rank)``: exact cosine of stated ``queries`` against all ``vectors``.

    Both have ``vec_id`` and ``embedding``; a vector is not its own neighbour,
    vectors of length zero or null are nobody's. Queries meet the vectors in blocks
    of about ``block``, and each task keeps its best ``k`` before the shuffle.
    """
    total = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    sized = lambda d: d.withColumn("size", F.sqrt(total(F.col("embedding"), F.col("embedding")))).filter("size > 0")
    blocks = max(1, -(-queries.count() // block))
    asks = sized(queries).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"), F.col("size").alias("q_size"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"))
    rows = sized(vectors).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    pairs = rows.join(asks, "block").filter(F.col("vec_id") != F.col("query_id"))
    scores = pairs.select(F.col("query_id"), "vec_id", F.round(total(F.col("q"), F.col("embedding")) / (F.col("q_size") * F.col("size")), 9).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
