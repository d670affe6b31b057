"""Candidate pairs by blocking keys, with exact caps that no large block can break."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyweave.functions.text import tokens
from tallyweave.operators.countries import ANY, OPEN, groups
from tallyweave.plans.durable import cut

#: Candidates a record takes from one block, and in all.
PER_KEY, PER_RECORD = 75, 200
#: Right records of a block that are put in order in one task; those of larger blocks are placed one by one.
WHOLE_BLOCK = 500_000
#: Right records of a block, about, that stand in one array where blocks are taken whole.
PART = 4096
#: Digests by which blocks are counted before they are counted each, and blocks that are broadcast at most.
BUCKETS, BROADCAST = 65_536, 100_000
#: Bits that tell blocks which are asked for from others.
BITS = 1 << 24
#: Forms of ids, such as S2- and nine digits, that are numbered at most.
ID_FORMS = 64
KEY_TYPES = ("pincode", "prefix4", "prefix6", "token", "bigram", "addr_token", "pin_prefix")


def key_array() -> Column:
    """Blocking keys ``struct(key_type, key)`` of a normalized record, each once."""
    core, pin, first = F.col("name_core"), F.col("pincode"), F.col("addr_token1")
    words = tokens(core)
    long_words = F.slice(F.filter(words, lambda t: F.length(t) >= 4), 1, 4)
    key = lambda kind, value: F.struct(F.lit(kind).alias("key_type"), value.alias("key"))
    maybe = lambda kind, value, ok: F.when(ok, F.array(key(kind, value))).otherwise(F.array().cast("array<struct<key_type:string,key:string>>"))
    return F.array_distinct(F.concat(
        maybe("pincode", pin, pin != ""),
        maybe("prefix4", F.substring(core, 1, 4), F.length(core) >= 3),
        maybe("prefix6", F.substring(core, 1, 6), F.length(core) >= 6),
        F.transform(long_words, lambda t: key("token", t)),
        maybe("bigram", F.concat_ws("_", F.slice(words, 1, 2)), F.size(words) > 0),
        maybe("addr_token", first, F.length(first) >= 3),
        maybe("pin_prefix", F.substring(pin, 1, 3), F.length(pin) >= 3),
    ))


def key_rows(records: DataFrame, keys: Column, right: bool) -> DataFrame:
    """``(entity_id, block, key_type, key)`` of an array of keys, once for each group of countries the record meets others in.

    ``block`` is a digest of group, kind and key.
    """
    rows = records.select("entity_id", groups(right).alias("countries"), keys.alias("k")).select("entity_id", "countries", F.explode("k").alias("k"))
    rows = rows.select("entity_id", F.explode("countries").alias("country"), "k.key_type", "k.key")
    return rows.select("entity_id", F.xxhash64("country", "key_type", "key").alias("block"), "key_type", "key")


def block_keys(records: DataFrame, right: bool, kinds: tuple[str, ...] = KEY_TYPES) -> DataFrame:
    """``(entity_id, block, key_type, key)`` of normalized records with their ``country_key``."""
    keys = key_array()
    return key_rows(records, keys if kinds == KEY_TYPES else F.filter(keys, lambda k: k["key_type"].isin(*kinds)), right)


def one_key(kind: str, key: Column) -> Column:
    """An array of one key, empty for ''."""
    return F.when(key != "", F.array(F.struct(F.lit(kind).alias("key_type"), key.alias("key")))).otherwise(F.array().cast("array<struct<key_type:string,key:string>>"))


def sound_key(name: Column) -> Column:
    """Sounds of the sorted words of a name: spelling variants and orders of one name share it."""
    return F.array_join(F.transform(F.array_sort(tokens(name)), lambda t: F.soundex(t)), " ")


def place_key(address: Column) -> Column:
    """The last word of an address that is no number: its town, state or country, whichever comes last."""
    return F.coalesce(F.try_element_at(F.filter(tokens(address), lambda t: ~t.rlike(r"\d")), F.lit(-1)), F.lit(""))


def hash24(c: Column) -> Column:
    """The first 24 bits of the MD5 digest."""
    return F.conv(F.substring(F.md5(c), 1, 6), 16, 10).cast("long")


def capped_pairs(left: DataFrame, right: DataFrame, per_key: int | None = PER_KEY) -> DataFrame:
    """``(s1_id, cand_id, key_type, key)`` of rows of :func:`key_rows`: of every block a left record meets, at most ``per_key`` right records.

    Which ones is fixed by digests: the block's records stand in order of their
    digest, and a left record takes a run of them, wrapping around, that starts
    at its own digest. The join is on block and position, so a block of any size
    gives each left record ``per_key`` rows and no more. Positions are counted in
    two levels, over the leading byte of the digest and inside it, so no task
    orders a whole block. With ``per_key`` None blocks are joined whole, and their
    pairs are as many as both sides make.
    """
    if per_key is None:
        return left.join(right.select("block", F.col("entity_id").alias("cand_id")), "block").select(F.col("entity_id").alias("s1_id"), "cand_id", "key_type", "key")
    # Counted and placed from one table, with the block's digest in the place of its three texts. Digests of records are
    # made anew behind the shuffle: they are far larger than ids and don't pack.
    rows = cut(right.select("block", "entity_id"), "keys").withColumn("lead", F.substring(F.md5("entity_id"), 1, 2))
    sizes = rows.groupBy("block", "lead").agg(F.count("*").alias("n"))
    starts = sizes.select("block", "lead", (F.sum("n").over(Window.partitionBy("block").orderBy("lead")) - F.col("n")).alias("start"))
    inside = F.row_number().over(Window.partitionBy("block", "lead").orderBy("digest", "entity_id")) - 1
    placed = rows.repartition("block", "lead").withColumn("digest", F.md5("entity_id")).withColumn("inside", inside).join(starts, ["block", "lead"]).select("block", F.col("entity_id").alias("cand_id"), (F.col("start") + F.col("inside")).alias("at"))
    totals = sizes.groupBy("block").agg(F.sum("n").alias("n"))
    seen = left.join(totals, "block")
    steps = F.explode(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(per_key)).cast("int") - 1))
    wanted = seen.select("block", "key_type", "key", F.col("entity_id").alias("s1_id"), "n", hash24(F.col("entity_id")).alias("h"), steps.alias("i"))
    wanted = wanted.select("block", "key_type", "key", "s1_id", F.pmod(F.col("h") + F.col("i"), F.col("n")).alias("at"))
    return wanted.join(placed, ["block", "at"]).select("s1_id", "cand_id", "key_type", "key")


def capped_candidates(left: DataFrame, right: DataFrame, kinds: tuple[str, ...] = KEY_TYPES, per_key: int | None = PER_KEY) -> DataFrame:
    """``(s1_id, cand_id, key_type, key)`` of normalized records by their blocking keys, see :func:`capped_pairs`."""
    return capped_pairs(block_keys(left, False, kinds), block_keys(right, True, kinds), per_key)


def keyed_candidates(left: DataFrame, right: DataFrame, key: Column, per_key: int | None = PER_KEY) -> DataFrame:
    """``(s1_id, cand_id)`` of records with one further key and country, see :func:`capped_pairs`."""
    rows = [key_rows(d, one_key("key", key), side) for d, side in ((left, False), (right, True))]
    return capped_pairs(*rows, per_key).select("s1_id", "cand_id").distinct()


#: Columns of a normalized record that its keys are made of.
KEY_COLUMNS = ("entity_id", "country_norm", "name_core", "pincode", "addr_token1")


class Codes:
    """Ids as numbers, which take a third of the room: those of one form (a beginning and a number of digits) count on from those of the form before.

    Where ids have no number at the end, or too many forms or digits, they stay texts.
    """

    def __init__(self, ids: DataFrame, column: str, run: int) -> None:
        pattern = r"(?s)^(.*?)([0-9]{1,15})$"
        c = F.col(column)
        form = F.struct(F.regexp_extract(c, pattern, 1).alias("start"), F.length(F.regexp_extract(c, pattern, 2)).alias("digits"))
        found = ids.groupBy(form.alias("form")).agg(F.max(F.regexp_extract(c, pattern, 2)).alias("top")).limit(ID_FORMS + 1).collect()
        tops = {(r.form.start, r.form.digits): int(r.top or 0) for r in found}
        forms = sorted(tops)
        self.offsets = [0]
        for form in forms:
            self.offsets.append(self.offsets[-1] + tops[form] + 1)
        self.kind = "string" if any(not digits for _, digits in forms) or len(forms) > ID_FORMS or self.offsets[-1] >= 1 << 62 else "int" if self.offsets[-1] < 1 << 31 else "bigint"
        self.packed = self.kind == "int" and self.offsets[-1] < 1 << 30 and run < 1 << 13
        self.forms, self.pattern = forms, pattern

    def of(self, c: Column) -> Column:
        if self.kind == "string":
            return c
        out = F.lit(None).cast("bigint")
        start, number = F.regexp_extract(c, self.pattern, 1), F.regexp_extract(c, self.pattern, 2)
        for (text, digits), offset in zip(self.forms, self.offsets, strict=False):
            out = F.when((start == text) & (F.length(number) == digits), number.cast("bigint") + offset).otherwise(out)
        return out.cast(self.kind)

    def back(self, c: Column) -> Column:
        if self.kind == "string":
            return c
        out = F.lit(None).cast("string")
        for (text, digits), offset in zip(self.forms, self.offsets, strict=False):
            out = F.when(c >= offset, F.concat(F.lit(text), F.lpad((c - offset).cast("string"), digits, "0"))).otherwise(out)
        return out

    def pack(self, run: Column) -> Column:
        """A run of codes in two bytes for most: the number of what follows, then steps between the codes in order; negative where a second number of 15 bits follows."""
        if not self.packed:
            return run
        before = lambda c: F.concat(F.array(F.lit(0)), F.slice(c, 1, F.size(c) - 1))
        step = lambda g: F.when(g < 32768, F.array(g.cast("smallint"))).otherwise(F.array((-1 - g.bitwiseAND(F.lit(32767))).cast("smallint"), F.shiftright(g, 15).cast("smallint")))
        of = lambda c: F.flatten(F.transform(F.zip_with(c, before(c), lambda x, y: x - y), step))
        # One element arrays name what is used twice.
        packed = F.transform(F.array(F.sort_array(run)), lambda c: of(c))
        return F.element_at(F.transform(packed, lambda p: F.concat(F.array(F.size(p).cast("smallint")), p)), 1)

    def unpacked(self, runs: np.ndarray) -> np.ndarray:
        """The codes of packed runs."""
        if not self.packed:
            return runs
        out, at = [], 0
        while at < len(runs):
            size = int(runs[at])
            own = runs[at + 1 : at + 1 + size].astype(np.int32)
            at += 1 + size
            more = np.flatnonzero(own < 0)
            if len(more):
                own[more] = (-1 - own[more]) | (own[more + 1] << 15)
                own = np.delete(own, more + 1)
            out.append(np.cumsum(own, dtype=np.int32))
        return np.concatenate(out) if out else np.array([], np.int32)

    @property
    def run_kind(self) -> str:
        return "smallint" if self.packed else self.kind

    def texts(self, codes: np.ndarray) -> list[bytes]:
        """The ids of an array of codes."""
        if self.kind == "string":
            return [x.encode() for x in codes.tolist()]
        at = np.searchsorted(self.offsets, codes, "right") - 1
        forms = [f"{text.replace('%', '%%')}%0{digits}d".encode() for text, digits in self.forms]
        return [forms[k] % n for k, n in zip(at.tolist(), (codes - np.array(self.offsets)[at]).tolist(), strict=True)]


def large_blocks(rows: DataFrame, most: int) -> list[int]:
    """Blocks of more than ``most`` rows. Buckets of blocks are counted first, so that the many small blocks are not shuffled."""
    bucket = F.pmod(F.col("block"), F.lit(BUCKETS)).cast("int")
    full = [r.b for r in rows.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).filter(F.col("n") > most).collect()]  # at most BUCKETS
    if not full:
        return []
    return [r.block for r in rows.filter(bucket.isin(full)).groupBy("block").agg(F.count("*").alias("n")).filter(F.col("n") > most).select("block").collect()]  # at most rows / most


def rows_asked_for(rows: DataFrame, asks: DataFrame) -> DataFrame:
    """``rows`` of all blocks that ``asks`` have, and of few others: a block's digest sets one of :data:`BITS` bits, which are broadcast."""
    bit = F.pmod(F.col("block"), F.lit(BITS)).cast("int")
    placed = (F.shiftright(bit, 15).alias("at"), bit.bitwiseAND(F.lit(32767)).alias("pos"))
    bits = cut(asks.select(*placed).groupBy("at").agg(F.bitmap_construct_agg("pos").alias("bits")), "bits")
    isset = F.expr("shiftright(cast(conv(hex(substring(bits, cast(pos div 8 as int) + 1, 1)), 16, 10) as int), pos % 8) & 1 = 1")
    return rows.select("*", *placed).join(F.broadcast(bits), "at").filter(isset).select(rows.columns)


def whole_runs(asks: DataFrame, rows: DataFrame, codes: Codes, part: int) -> DataFrame:
    """``(s1_id, run)`` of all right records of every block that is asked for: those of a block stand in arrays of about ``part`` codes, packed once for all that ask.

    Each array of a large block meets the left records in a task of its own, so neither a block nor its pairs ever do in one.
    """
    size = rows.groupBy("block").agg(F.count("*").alias("n")).filter(F.col("n") > part)
    split = cut(size.select("block", F.ceil(F.col("n") / part).cast("int").alias("parts")), "split")
    parts = F.coalesce("parts", F.lit(1))
    placed = rows.select("block", codes.of(F.col("entity_id")).alias("code")).join(split, "block", "left").select("block", F.pmod(F.xxhash64("code"), parts).cast("int").alias("part"), "code")
    arrays = placed.groupBy("block", "part").agg(codes.pack(F.collect_set("code")).alias("run"))
    wanted = asks.join(split, "block", "left").select("block", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.col("entity_id").alias("s1_id"))
    return wanted.join(arrays.hint("shuffle_merge"), ["block", "part"]).select("s1_id", "run")


def candidate_runs(left: DataFrame, right: DataFrame, per_key: int | None, whole_block: int = WHOLE_BLOCK, few: bool = False, part: int = PART) -> tuple[DataFrame, Codes]:
    """``(s1_id, runs)`` of every left record: the candidates of :func:`capped_pairs` over all its keys as codes, packed by :meth:`Codes.pack`, repeated as often as keys are shared.

    A block's right records are put in order in one array, of which a left record's run is a slice: candidates
    are shuffled once, as codes in one row for each left record and key, to the left record's task.
    With ``per_key`` None blocks are taken whole, see :func:`whole_runs`.
    Where left records are ``few``, right rows of blocks that none asks for are left out before any shuffle.
    """
    codes = Codes(right, "entity_id", part if per_key is None else per_key)
    asks = block_keys(left, False).select("entity_id", "block")
    rows = block_keys(right, True).select("entity_id", "block")
    # Every right record is in the group that only left records without a country ask for.
    nameless = block_keys(left.filter("country_key = ''"), False).select("block").distinct()
    few = cut(nameless, "nameless")
    if few.count() <= BROADCAST:
        rows = group_rows(right, False).unionByName(group_rows(right, True).join(F.broadcast(few), "block", "left_semi").select("entity_id", "block"))
    if few:
        rows = rows_asked_for(rows, asks)
    none = left.select(F.col("entity_id").alias("s1_id"), F.array().cast(f"array<{codes.run_kind}>").alias("run"))
    gathered = lambda parts: reduce(DataFrame.unionByName, parts).groupBy("s1_id").agg(F.flatten(F.collect_list("run")).alias("runs"))
    if per_key is None:
        return gathered([whole_runs(asks, rows, codes, part), none]), codes
    large = large_blocks(rows, whole_block)
    parts = []
    if large:
        big = F.col("block").isin(large)
        pairs = capped_pairs(asks.filter(big).select("*", F.lit("").alias("key_type"), F.lit("").alias("key")), rows.filter(big), per_key)
        parts.append(pairs.select("s1_id", codes.pack(F.array(codes.of(F.col("cand_id")))).alias("run")))
        asks, rows = asks.filter(~big), rows.filter(~big)
    placed = rows.select("block", codes.of(F.col("entity_id")).alias("code")).repartition("block")
    ordered = placed.groupBy("block").agg(F.sort_array(F.collect_list(F.struct(F.md5(codes.back(F.col("code"))).alias("digest"), "code"))).alias("codes")).select("block", F.col("codes.code").alias("codes"), F.size("codes").alias("n"))
    h, n = F.pmod(hash24(F.col("entity_id")), F.col("n")).cast("int"), F.col("n")
    most = F.least(n, F.lit(per_key))
    run = F.when(h + most <= n, F.slice("codes", h + 1, most)).otherwise(F.concat(F.slice("codes", h + 1, n - h), F.slice("codes", 1, most - (n - h))))
    parts.append(asks.join(ordered.hint("shuffle_merge"), "block").select(F.col("entity_id").alias("s1_id"), codes.pack(run).alias("run")))
    return gathered([*parts, none]), codes


def group_rows(right: DataFrame, any_country: bool) -> DataFrame:
    """``(entity_id, block)`` of right records in the group of their country, or in the one that holds them all."""
    group = F.lit(ANY) if any_country else F.when(F.col("country_key") != "", F.col("country_key")).otherwise(F.lit(OPEN))
    rows = right.select("entity_id", group.alias("country"), F.explode(key_array()).alias("k"))
    return rows.select("entity_id", F.xxhash64("country", "k.key_type", "k.key").alias("block"))


def rule_codes(left: DataFrame, right: DataFrame, per_key: int | None, per_record: int | None, whole_block: int = WHOLE_BLOCK, more: DataFrame | None = None, few: bool = False) -> tuple[DataFrame, Codes]:
    """``(s1_id, codes)`` of every left record: its :func:`rule_candidates` in one array, and those of ``more (s1_id, cand_id)`` beside them, each once."""
    runs, codes = candidate_runs(left, right, per_key, whole_block, few)
    own = None if more is None else more.groupBy("s1_id").agg(F.collect_list(codes.of(F.col("cand_id"))).alias("more"))
    runs = runs.withColumn("more", F.array().cast(f"array<{codes.kind}>")) if own is None else runs.join(own, "s1_id", "left")
    kind = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[codes.kind]

    def best(s1_id: bytes, run: np.ndarray) -> np.ndarray:
        found, shared = np.unique(run, return_counts=True)
        if per_record is None or len(found) <= per_record:
            return found
        # Digests are needed only among those that share the number of keys of the last one taken.
        least = -np.partition(-shared, per_record - 1)[per_record - 1]
        sure, tied = found[shared > least], found[shared == least]
        digests = b"".join([hashlib.md5(s1_id + x).digest() for x in codes.texts(tied)])
        halves = np.frombuffer(digests, ">u8").reshape(-1, 2)
        return np.concatenate([sure, tied[np.lexsort((halves[:, 1], halves[:, 0]))[: per_record - len(sure)]]])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.string())
            (flat, ends), (more, upto) = ((x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()) for x in (batch.column(1), batch.column(2)))
            out = [best(x.encode(), codes.unpacked(flat[i:j])) for x, i, j in zip(ids.to_pylist(), ends[:-1], ends[1:], strict=True)]
            out = [np.union1d(x, more[i:j]) if j > i else x for x, i, j in zip(out, upto[:-1], upto[1:], strict=True)]
            sizes = np.cumsum([0, *map(len, out)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(out) if out else [], kind))], names=["s1_id", "codes"])

    return runs.mapInArrow(chosen, f"s1_id string, codes array<{codes.kind}>"), codes


def rule_candidates(left: DataFrame, right: DataFrame, per_key: int | None = PER_KEY, per_record: int | None = PER_RECORD, more: DataFrame | None = None, few: bool = False) -> DataFrame:
    """Distinct ``(s1_id, cand_id)`` over all kinds of keys, at most ``per_record`` for a left record: those that share most keys, then by digest.

    ``None`` in the place of a cap takes all. Pairs of ``more``, of the same left and right records, are added
    to a record's candidates in its own task, without a shuffle of pairs. For ``few`` left records see :func:`candidate_runs`.
    """
    return listed_pairs(*rule_codes(left, right, per_key, per_record, more=more, few=few))


def listed_pairs(lists: DataFrame, codes: Codes) -> DataFrame:
    """``(s1_id, cand_id)`` of lists of :func:`rule_codes`."""
    return lists.select("s1_id", F.explode("codes").alias("code")).select("s1_id", codes.back(F.col("code")).alias("cand_id"))


def rule_lists(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(s1_id, ids)`` of every left record: its :func:`rule_candidates` in one array."""
    lists, codes = rule_codes(left, right, PER_KEY, PER_RECORD)
    return lists.select("s1_id", F.transform("codes", codes.back).alias("ids"))


def rule_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row ``(pairs)``: the number of :func:`rule_candidates`, for which none has to be chosen."""
    runs, codes = candidate_runs(left, right, PER_KEY)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = batch.column(0).values.to_numpy(zero_copy_only=False), batch.column(0).offsets.to_numpy()
            sizes = [min(PER_RECORD, len(np.unique(codes.unpacked(flat[i:j])))) for i, j in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], names=["n"])

    return runs.select("runs").mapInArrow(counted, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"))


def hybrid_candidates(*sets: DataFrame) -> DataFrame:
    """Union of candidate sets."""
    out = sets[0].select("s1_id", "cand_id")
    for more in sets[1:]:
        out = out.union(more.select("s1_id", "cand_id"))
    return out.distinct()


def minhash_candidates(left: DataFrame, right: DataFrame, text: str = "name_norm", bands: int = 6, rows: int = 2, per_key: int | None = PER_KEY) -> DataFrame:
    """``(s1_id, cand_id)`` of records whose character 3-grams share a band of minimal digests, whatever their countries.

    Each of ``bands * rows`` functions is the least digest of the salted grams;
    a record's band is the digest of its ``rows`` minima. Blocks are capped as in
    :func:`capped_pairs`. Texts shorter than three characters have no band.
    """
    from tallyweave.functions.similarity import char_ngrams

    def banded(d: DataFrame) -> DataFrame:
        grams = d.select("entity_id", char_ngrams(F.col(text)).alias("g")).filter(F.size("g") > 0)
        least = lambda k: F.array_min(F.transform("g", lambda x: F.substring(F.md5(F.concat(F.lit(f"{k}:"), x)), 1, 8)))
        keys = F.array(*(F.concat(F.lit(f"{b}:"), *(least(b * rows + r) for r in range(rows))) for b in range(bands)))
        return grams.select("entity_id", F.explode(keys).alias("key")).select("entity_id", F.xxhash64("key").alias("block"), F.lit("band").alias("key_type"), "key")

    return capped_pairs(banded(left), banded(right), per_key).select("s1_id", "cand_id").distinct()


def blocking_recall(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: recall, captured and all true pairs, and candidates per labelled record.

    ``truth`` has ``s1_id`` and the array ``targets``; recall is 1 without true pairs.
    """
    true_pairs = truth.select("s1_id", F.explode("targets").alias("cand_id")).distinct()
    hit = true_pairs.join(pairs.select("s1_id", "cand_id").distinct(), ["s1_id", "cand_id"], "left_semi")
    mine = pairs.select("s1_id", "cand_id").distinct().join(truth.select("s1_id").distinct(), "s1_id", "left_semi")
    counts = [d.agg(F.count("*").alias(n)) for d, n in ((hit, "captured"), (true_pairs, "total_true"), (mine, "pairs"), (truth.select("s1_id").distinct(), "records"))]
    one = counts[0].crossJoin(counts[1]).crossJoin(counts[2]).crossJoin(counts[3])  # single rows
    return one.select(
        F.when(F.col("total_true") == 0, 1.0).otherwise(F.try_divide(F.col("captured").cast("double"), "total_true")).alias("recall"),
        "captured", "total_true", F.coalesce(F.try_divide(F.col("pairs").cast("double"), "records"), F.lit(0.0)).alias("avg_candidates"),
    )


def reduction_ratio(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Share of all left-right pairs that blocking leaves out."""
    return reduction_of(pairs.select("s1_id", "cand_id").distinct().agg(F.count("*").alias("pairs")), left, right)


def reduction_of(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """:func:`reduction_ratio` from one row with the number of distinct ``pairs``."""
    counts = [d.agg(F.count("*").alias(n)) for d, n in ((left, "n_left"), (right, "n_right"))]
    one = pairs.crossJoin(counts[0]).crossJoin(counts[1])  # single rows
    return one.select("pairs", (1 - F.coalesce(F.try_divide(F.col("pairs").cast("double"), F.col("n_left") * F.col("n_right")), F.lit(0.0))).alias("reduction_ratio"))


def missed_patterns(pairs: DataFrame, truth: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Counts of true pairs that blocking missed, by what the two records have in common."""
    true_pairs = truth.select("s1_id", F.explode("targets").alias("cand_id")).distinct()
    missed = true_pairs.join(pairs.select("s1_id", "cand_id").distinct(), ["s1_id", "cand_id"], "left_anti")
    cols = ("name_core", "pincode", "country_norm", "has_address")
    a = left.select(F.col("entity_id").alias("s1_id"), *(F.col(c).alias(f"{c}_1") for c in cols))
    b = right.select(F.col("entity_id").alias("cand_id"), *(F.col(c).alias(f"{c}_2") for c in cols))
    seen = missed.join(a, "s1_id").join(b, "cand_id")
    return seen.groupBy(
        (F.col("name_core_1") == F.col("name_core_2")).alias("same_core"),
        ((F.col("pincode_1") == F.col("pincode_2")) & (F.col("pincode_1") != "")).alias("same_pincode"),
        (F.col("country_norm_1") == F.col("country_norm_2")).alias("same_country"),
        ((F.col("has_address_1") == 1) & (F.col("has_address_2") == 1)).alias("both_addresses"),
    ).agg(F.count("*").alias("missed"))
