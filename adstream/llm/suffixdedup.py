"""Remove every byte covered by a string of ``length`` bytes that also starts elsewhere.

Suffixes that cannot be repeated are never sorted. Of the fragments of ``FRAGMENT`` bytes in
each such string the one with the least hash is its anchor, so equal strings have equal
anchors at equal places. Anchors whose fragment occurs once in the corpus are dropped. An
anchor's context holds the strings it is the anchor of and no others, so each string is in
one context, and copies differ in the contexts at their edges alone; contexts that are equal
as a whole are counted, and one of them stands for all.

Where contexts of one fragment differ (at the edges of copies), shards of them are put into
suffix arrays by Larsson-Sadakane refinement. Kasai's common prefixes then show which strings
start at another place too. A fragment's contexts share a shard; where they are too many,
they are spread over several, each shard hands on one of every string it holds, as a digest,
and the digests of all shards, sorted, are merged by binary search. Only strings are compared
whose core, the bytes they share with their neighbours, more than one context holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.common import prepare, saved, scratch, text_column, utf8
from adstream.llm.suffixes import PACKED, common_prefixes, packed, suffix_array

LENGTH = 200
FRAGMENT = 100
# Bytes that are hashed at once; a place in them takes the lower bits of a key.
CHUNK_BITS = 18
# Contexts in a shard.
SHARD = 3000
# Starts that share a core, where a fragment's contexts are spread over shards.
STEP = 16
# Odd numbers whose powers weigh the bytes of a string, modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MULTIPLIER = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    def row(x: int) -> np.ndarray:
        steps = np.full(n, x, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return row(base), row(pow(base, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * MULTIPLIER
    return x ^ (x >> np.uint64(32))


class Hashes:
    """64-bit hashes of any substring of some bytes, for each base."""

    def __init__(self, data: np.ndarray, base: int):
        self.powers, self.inverse = _powers(base, (1 << CHUNK_BITS) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def fragments(self, size: int) -> np.ndarray:
        return _mixed((self.sums[size:] - self.sums[:-size]) * self.inverse[: len(self.sums) - size])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = x
    rows = padded.reshape(-1, width)
    to_left = np.minimum.accumulate(rows, axis=1).ravel()
    to_right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_right[: n - width + 1], to_left[width - 1 : n])


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, fragment: int = FRAGMENT):
    """Anchors in some texts that follow one another in ``data`` and end at ``ends``.

    Returns their places in ``data``, bytes of context before and after each place (from the
    first string it is the anchor of to the end of the last; they follow one another), the
    hashes of fragment and context. ``data`` has at most ``1 << CHUNK_BITS`` bytes.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    first = Hashes(data, BASES[0])
    fragments = first.fragments(fragment)
    low = np.uint64((1 << CHUNK_BITS) - 1)
    keys = (fragments & ~low) | np.arange(len(fragments), dtype=np.uint64)
    best = _sliding_min(keys, length - fragment + 1)
    # Only strings that end in the text they start in.
    begins = np.r_[0, ends[:-1]]
    size = np.maximum(ends - begins - length + 1, 0)
    strings = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begins, size)
    place = (best[strings] & low).astype(np.int64)
    if not len(place):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    new = np.r_[True, place[1:] != place[:-1]]
    place, last = place[new], strings[np.r_[new[1:], True]]
    before = place - strings[new]
    after = last + length - place
    context = Hashes(data, BASES[1]).of(place - before, place + after)
    context = _mixed(context + before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return place, before, after, fragments[place], context


def _text_anchors(data: np.ndarray, length: int, fragment: int):
    """Anchors of one long text, from chunks that overlap."""
    parts, step = [], (1 << CHUNK_BITS) - 2 * length
    for at in range(0, max(len(data) - length, 0) + 1, step - length):
        # Strings and their anchors' contexts reach ``length`` beyond a chunk on both sides.
        begin, end = max(at - length, 0), min(at + step, len(data))
        piece = data[begin:end]
        place, before, after, fh, ch = anchors(piece, np.array([len(piece)]), length, fragment)
        # All strings that it can be the anchor of have to be in the piece.
        whole_left = (place >= length - fragment) | (begin == 0)
        whole_right = (place + length <= len(piece)) | (end == len(data))
        keep = whole_left & whole_right
        parts.append([x[keep] for x in (place + begin, before, after, fh, ch)])
    place, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
    place, first = np.unique(place, return_index=True)
    return place, *(x[first] for x in rest)


def _anchor_batches(length: int, fragment: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch["text"])
            n, at, found = batch.num_rows, 0, []
            while at < n:
                # As many texts as fit into a chunk, or one that does not.
                last = max(int(np.searchsorted(offsets, offsets[at] + (1 << CHUNK_BITS), "right")) - 1, at + 1)
                part = data[offsets[at] : offsets[last]]
                ends = offsets[at + 1 : last + 1] - offsets[at]
                if len(part) > 1 << CHUNK_BITS:
                    rows = _text_anchors(part, length, fragment)
                else:
                    rows = anchors(part, ends, length, fragment)
                text = np.searchsorted(ends, rows[0], "right")
                place = rows[0] - np.r_[0, ends[:-1]][text]
                found.append((text + at, place, *rows[1:]))
                at = last
            text, place, before, after, fh, ch = (np.concatenate(x) for x in zip(*found, strict=True))
            counts = np.r_[0, np.cumsum(np.bincount(text, minlength=n))].astype(np.int32)
            items = pa.StructArray.from_arrays(
                [
                    pa.array(place.astype(np.int32)),
                    pa.array(before.astype(np.int16)),
                    pa.array(after.astype(np.int16)),
                    pa.array(fh.view(np.int64)),
                    pa.array(ch.view(np.int64)),
                ],
                ["place", "before", "after", "fh", "ch"],
            )
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], batch["print"], pa.ListArray.from_arrays(pa.array(counts), items)],
                ["doc", "print", "anchors"],
            )

    return find


def shard_repeats(contexts: list[bytes], physical: np.ndarray, copies: np.ndarray, length: int):
    """Which strings of some contexts start elsewhere too.

    ``physical`` is the place of each context in the corpus (document number, byte), so that
    strings in overlapping contexts are known as one. Returns, for every string in array
    order, its context, its start there, whether it is repeated, and its class: equal
    strings have one.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    total = sizes + 1
    begin = np.cumsum(total) - total
    n = int(total.sum())
    raw = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    symbols = raw.astype(np.int64) + 1
    symbols[begin + sizes] = 0
    # All is sorted to the end of the shard: only a whole order lets lengths carry over.
    key = packed(symbols)
    order = suffix_array(key, known=PACKED)
    context = np.repeat(np.arange(len(sizes)), total)
    shared = common_prefixes(key, order, length)
    start = np.arange(n) - begin[context]
    full = (sizes[context] - start >= length)[order]
    class_ = np.cumsum(shared < length)[full]
    order = order[full]
    own, start = context[order], start[order]
    if not len(order):
        return own, start, np.zeros(0, bool), class_
    class_ = np.cumsum(np.r_[True, class_[1:] != class_[:-1]]) - 1
    doc, byte = physical[own, 0], physical[own, 1] + start
    first = np.flatnonzero(np.r_[True, class_[1:] != class_[:-1]])
    several = np.logical_or.reduceat(copies[own] > 1, first)
    for x in (doc, byte):
        several |= np.minimum.reduceat(x, first) != np.maximum.reduceat(x, first)
    return own, start, several[class_], class_


def _intervals(own: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of following starts in one context: context, first and last start."""
    if not len(own):
        return own, start, start
    at = np.lexsort((start, own))
    own, start = own[at], start[at]
    new = np.r_[True, (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)]
    last = np.r_[new[1:], True]
    return own[new], start[new], start[last]


def _handed_on(contexts, before, own, start, length):
    """Strings that other shards have to know, by context and core.

    Strings of one context that start within ``STEP`` bytes of each other have a core in
    common, at places that are the same for all contexts: equal strings have equal cores, so
    only strings whose core other shards hold too need to be compared.
    """
    band = (before[own] - start) // STEP
    at = np.lexsort((start, band, own))
    own, start, band = own[at], start[at], band[at]
    new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (band[1:] != band[:-1])])
    rows = []
    for a, b in zip(new, [*new[1:], len(own)], strict=True):
        c = own[a]
        data = np.frombuffer(contexts[c], np.uint8)
        core = before[c] - band[a] * STEP
        begins = np.r_[core, start[a:b]]
        ends = np.r_[core + length - STEP + 1, start[a:b] + length]
        digests = [Hashes(data, base).of(begins, ends).view(np.int64) for base in BASES]
        rows.append((c, digests, start[a:b]))
    return rows


STRINGS = pa.list_(
    pa.struct([("first", pa.int32()), ("digest1", pa.int64()), ("digest2", pa.int64()), ("byte", pa.int64())])
)
SHARD_ROWS = (
    "fh long, ch long, first int, last int, core1 long, core2 long, doc long, "
    "strings array<struct<first:int,digest1:long,digest2:long,byte:long>>"
)


def _shard(length: int):
    schema = pa.schema(
        [("fh", pa.int64()), ("ch", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
         ("core1", pa.int64()), ("core2", pa.int64()), ("doc", pa.int64()), ("strings", STRINGS)]
    )

    def sort(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        contexts = table["context"].to_pylist()
        fh, ch, before, row = (table[c].to_numpy() for c in ("fh", "ch", "before", "row"))
        before = before.astype(np.int64)
        physical = np.stack([row, table["place"].to_numpy() - before], 1)
        own, start, repeated, class_ = shard_repeats(contexts, physical, table["copies"].to_numpy(), length)
        if not len(own):
            return schema.empty_table()
        c, first, last = _intervals(own[repeated], start[repeated])
        n = len(c)
        runs = pa.table(
            [
                pa.array(fh[c]), pa.array(ch[c]),
                pa.array((first - before[c]).astype(np.int32)), pa.array((last - before[c]).astype(np.int32)),
                *(pa.nulls(n, f.type) for f in list(schema)[4:]),
            ],
            schema=schema,
        )
        spread = table["spread"].to_numpy()[own]
        # Each string once, and every one that is not yet known to be repeated.
        some = np.flatnonzero(spread & (~repeated | np.r_[True, class_[1:] != class_[:-1]]))
        rows = [
            {
                "fh": int(fh[c]), "ch": int(ch[c]), "core1": int(d1[0]), "core2": int(d2[0]), "doc": int(row[c]),
                "strings": [
                    {"first": int(s - before[c]), "digest1": int(x), "digest2": int(y), "byte": int(physical[c, 1] + s)}
                    for s, x, y in zip(starts, d1[1:], d2[1:], strict=True)
                ],
            }
            for c, (d1, d2), starts in (_handed_on(contexts, before, own[some], start[some], length) if len(some) else ())
        ]
        return pa.concat_tables([runs, pa.Table.from_pylist(rows, schema)])

    return sort


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Find digests of other places among the sorted digests of all shards."""
    tables = [pa.Table.from_batches([b]) for b in batches]
    if not tables:
        return
    rows = pa.concat_tables(tables).combine_chunks()
    keys = np.stack([rows[c].to_numpy() for c in ("digest1", "digest2", "doc", "byte")], 1)
    places = np.unique(keys, axis=0)
    order = np.lexsort((places[:, 1], places[:, 0]))
    pairs = np.ascontiguousarray(places[order, :2]).view("i8,i8")[:, 0]
    asked = np.ascontiguousarray(keys[:, :2]).view("i8,i8")[:, 0]
    other = np.searchsorted(pairs, asked, "right") - np.searchsorted(pairs, asked, "left") > 1
    found = rows.filter(pa.array(other))
    yield from pa.table(
        [found["fh"], found["ch"], found["first"], found["first"]], names=["fh", "ch", "first", "last"]
    ).to_batches()


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch["text"])
        data, text = data.tobytes(), pc.list_parent_indices(batch["wanted"]).to_numpy()
        wanted = dict(zip(WANTED.names[:-1], pc.list_flatten(batch["wanted"]).flatten(), strict=True))
        place, before, after = (wanted[c].to_numpy().astype(np.int64) for c in ("place", "before", "after"))
        place = place + offsets[text]
        begin, end = (place - before).tolist(), (place + after).tolist()
        for at in range(0, len(begin), 4096):
            part = slice(at, at + 4096)
            context = pa.array([data[a:b] for a, b in zip(begin[part], end[part], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(x[part] for x in wanted.values()), context], schema=WANTED)


WANTED = pa.schema(
    [("fh", pa.int64()), ("ch", pa.int64()), ("row", pa.int64()), ("place", pa.int32()), ("before", pa.int16()),
     ("after", pa.int16()), ("copies", pa.int64()), ("shard", pa.int64()), ("spread", pa.bool_()), ("context", pa.binary())]
)


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with a key: ``doc`` and ``print``. Rows with equal keys are repeated rows."""
    text = text_column()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64(text).alias("print"),
        text.alias("text"),
    )


def repeated_starts(docs: DataFrame, length: int = LENGTH, fragment: int = FRAGMENT, shard: int = SHARD) -> DataFrame:
    """``doc``, ``print`` and ``starts``, runs of places at which a repeated string starts."""
    spark = prepare(docs.sparkSession)
    shape = (
        "doc long, print long, anchors array<struct<place:int,before:smallint,after:smallint,fh:long,ch:long>>"
    )
    texts = _keyed(docs)
    per_text = saved(
        texts.where(F.octet_length("text") >= length)
        .select("doc", "print", "text")
        .mapInArrow(_anchor_batches(length, fragment), shape)
        .withColumn("row", F.monotonically_increasing_id()),
        scratch(spark, "anchors"),
    )
    each = per_text.select("row", F.inline("anchors"))
    several = each.groupBy("fh").agg(F.count("*").alias("n")).where("n > 1").select("fh")
    members = saved(each.join(several, "fh", "left_semi"), scratch(spark, "members"))
    contexts = saved(
        members.groupBy("fh", "ch").agg(
            F.count("*").alias("copies"), F.min(F.struct("row", "place", "before", "after")).alias("one")
        ),
        scratch(spark, "contexts"),
    )
    # Fragments with contexts that differ.
    unlike = saved(
        contexts.groupBy("fh").agg(F.count("*").alias("n")).where("n > 1"), scratch(spark, "unlike")
    )
    shards = -(-(unlike.agg(F.sum("n")).first()[0] or 0) // shard)
    spread = F.col("n") > shard
    own_shard = F.when(
        spread,
        F.xxhash64("fh", F.pmod(F.xxhash64("ch"), F.ceil(F.col("n") / shard))),
    ).otherwise(F.pmod(F.xxhash64("fh"), F.lit(max(shards, 1))))
    wanted = contexts.join(unlike, "fh").select(
        "fh", "ch", "one.row", "one.place", "one.before", "one.after", "copies",
        own_shard.alias("shard"), spread.alias("spread"),
    )
    names = ["fh", "ch", "row", "place", "before", "after", "copies", "shard", "spread"]
    by_text = (
        wanted.groupBy("row")
        .agg(F.collect_list(F.struct(*names)).alias("wanted"))
        .join(per_text.select("row", "doc", "print"), "row")
        .groupBy("doc", "print")
        .agg(F.flatten(F.collect_list("wanted")).alias("wanted"))
    )
    # A repeated row would give its contexts again.
    from_texts = texts.select("doc", "print", "text").join(by_text, ["doc", "print"])
    bytes_shape = (
        "fh long, ch long, row long, place int, before smallint, after smallint, copies long, shard long, "
        "spread boolean, context binary"
    )
    found = saved(
        from_texts.select("text", "wanted")
        .mapInArrow(_contexts, bytes_shape)
        .groupBy("shard")
        .applyInArrow(_shard(length), SHARD_ROWS),
        scratch(spark, "shards"),
    )
    alike = contexts.where("copies > 1").select(
        "fh",
        "ch",
        (-F.col("one.before")).cast("int").alias("first"),
        (F.col("one.after") - length).cast("int").alias("last"),
    )
    runs = ["fh", "ch", "first", "last"]
    repeated = found.where("core1 IS NULL").select(*runs).unionByName(alike)
    handed_on = found.where("core1 IS NOT NULL")
    if not handed_on.isEmpty():
        cores = handed_on.groupBy("core1", "core2").agg(F.count("*").alias("n")).where("n > 1")
        shared = handed_on.join(cores, ["core1", "core2"], "left_semi").select("fh", "ch", "doc", F.inline("strings"))
        merged = shared.repartition("digest1").mapInArrow(_merge, "fh long, ch long, first int, last int")
        repeated = repeated.unionByName(merged)
    per_context = repeated.groupBy("fh", "ch").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    per_context = saved(per_context, scratch(spark, "repeated"))
    starts = members.join(per_context, ["fh", "ch"]).select(
        "row", F.transform("runs", lambda r: F.struct((F.col("place") + r["first"]).alias("a"), (F.col("place") + r["last"]).alias("b"))).alias("runs")
    )
    return (
        starts.groupBy("row")
        .agg(F.flatten(F.collect_list("runs")).alias("starts"))
        .join(per_text.select("row", "doc", "print"), "row")
        .groupBy("doc", "print")
        .agg(F.flatten(F.collect_list("starts")).alias("starts"))
    )


def _spans(a: np.ndarray, b: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal covered runs of some texts that follow one another: begins, ends and texts.

    ``a`` and ``b`` are places at which covered strings begin and end, ``text`` their texts.
    """
    at = np.argsort(a, kind="stable")
    a, b, text = a[at], np.maximum.accumulate(b[at]), text[at]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] > b[:-1]) | (text[1:] != text[:-1])
    return a[new], b[np.roll(new, -1)], text[new]


def remove_repeats(docs: DataFrame, length: int = LENGTH, fragment: int = FRAGMENT, shard: int = SHARD) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes that remain.

    Texts are UTF-8 bytes, NULL the empty text; strings do not cross texts and are judged
    on the input. What remains may end inside a character, so it is binary. Rows with equal
    ``doc_id`` and text are copies of each other like any others. Other columns are ignored;
    an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    starts = saved(repeated_starts(docs, length, fragment, shard), scratch(docs.sparkSession, "starts"))
    rows = _keyed(docs).join(starts, ["doc", "print"], "left").select("doc_id", "text", "starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch["text"])
            n, starts = batch.num_rows, batch["starts"]
            text = pc.list_parent_indices(starts).to_numpy()
            a, b = (x.to_numpy().astype(np.int64) + offsets[text] for x in pc.list_flatten(starts).flatten())
            begin, end, text = _spans(a, b + length, text)
            edges = np.zeros(len(data) + 1, np.int8)
            edges[begin] += 1
            edges[end] -= 1
            removed = np.zeros(n, np.int64)
            np.add.at(removed, text, end - begin)
            sizes = np.diff(offsets)
            ends = np.r_[0, np.cumsum(sizes - removed)].astype(np.int32)
            left = data[np.cumsum(edges[:-1], dtype=np.int8) == 0]
            kept = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(left)])
            longs = [pa.array(x) for x in (sizes, removed, np.bincount(text, minlength=n))]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *longs, kept],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
