"""Point-in-time features of sales: what was known of a client at a moment, over windows of days.

An event that happened at `ts` counts in a window of d days at the moments from `start`, when it had happened and was known, to
before ts + d: a sum over a window is the sum of what has started less the sum of what has expired. For each client and stretch
of time, a chunk, numpy sorts starts and expiries, adds up what they carry, and finds with searchsorted, for all moments of the
chunk at once, how much of either lies before. Events of few clients are read together: chunks are numbered, and a key is the
chunk's number and the time.

Distinct items are counted by intervals that have been made disjoint first: in the order of starts, a line adds to what earlier
lines of its client and item cover only what lies between their last expiry and its own. The latest click of a window is the
latest of all that have started, if it is young enough: of two clicks the later expires later. A label (does the client buy
again within seven days) is an event that starts seven days before the sale and expires with it.

A client of more than LIMIT events is cut by time into chunks of about that many events. An event goes to the chunks that its
start or its expiries lie in. What a chunk has to begin with, its base, is the total of the chunks before: sums of starts less
expiries by client and chunk, summed up over the chunks of the client, block by block, and the latest click likewise. Equal
points in time of such a client's lines are summed up before, so one sale that holds a third of all lines is a few rows. Lines
find their sale by a join where the sales that hold over one in 1,000 lines are dealt out over SALTS parts.

Neither the driver nor a broadcast holds what grows with the input: at most 1,000 ids of such sales, and clients over LIMIT
events, at most MOST of them as the limit rises with the events.

Nulls: a sale without client or time has no row; one without an id is taken as crc32 0, one not known to have arrived counts as
a label alone. Clicks without client, time or arrival and lines without sale, shipping time or a sale that counts are left out.
Money that is null or no number is 0, items that are null are not counted, a latest click without id gives null. Fully equal
clicks count once; repeated sales and lines each. No rows give no rows; further columns are ignored, but those of clicks take
part in being equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType
from pyspark.sql.window import Window

from .base import passing, small, stored, tidied
from .merkle import CRC, CRC_TABLE

DAY = 86_400_000_000
WINDOWS, HORIZON, DELAY, JITTER = (2, 14), 7 * DAY, 240 * 60_000_000, 259_200
LIMIT, MOST, SALTS, BLOCK, BUFFER = 20_000, 500_000, 64, 512, 300_000
SALE, CLICK, LINE, BASE = range(4)
LEAST, GREATEST = -(1 << 62), 1 << 62
#: What is summed up, for each window; a base has these, then the label.
SUMS = ("n_clicks", "n_purchases", "click_cents", "n_sales", "sale_cents", "n_lines", "line_cents", "n_items")
EVENT = "client bigint, kind int, ts bigint, start bigint, at bigint, id bigint, cents bigint, n bigint, item bigint, prior bigint"
COLUMNS = [part.split()[0] for part in EVENT.split(", ")]


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp, without a zone or with one."""
    if not isinstance(df.schema[name].dataType, TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp"))
    since = f"(`{name}` - TIMESTAMP_NTZ'1970-01-01 00:00:00')"  # taken apart, as functions of timestamps would bring in the session's zone
    parts = [f"CAST(extract({unit} FROM {since}) * {size}L AS BIGINT)" for unit, size in (("DAY", DAY), ("HOUR", DAY // 24), ("MINUTE", DAY // 1440), ("SECOND", 1_000_000))]
    return F.expr(" + ".join(parts))


def cents(amount: str) -> Column:
    x = F.col(amount).cast("double")
    whole = F.floor(100 * x + 0.5)
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0)).otherwise(whole).cast("bigint")


def _event(df: DataFrame, kind: int, **columns: Column | str) -> DataFrame:
    given = {"kind": F.lit(kind), "n": F.lit(1), **columns}
    return df.select(*[given.get(c, F.lit(None)).cast(kind_of).alias(c) for c, kind_of in (part.split() for part in EVENT.split(", "))])


def sale_events(sales: DataFrame) -> DataFrame:
    sold, known = micros(sales, "sold_at"), micros(sales, "arrived_at") + DELAY
    at = sold + F.coalesce(F.pmod(F.crc32(F.col("sale_id").cast("string")), F.lit(JITTER)), F.lit(0)) * 1_000_000
    rows = sales.where("client_id IS NOT NULL AND sold_at IS NOT NULL")
    return _event(rows, SALE, client=F.col("client_id"), ts=sold, start=F.when(known.isNotNull(), F.greatest(sold, known)), at=at, id=F.col("sale_id"), cents=cents("total"))


def click_events(clicks: DataFrame) -> DataFrame:
    """Fully equal rows once. Texts are told apart by their SHA-256, so that they are not shuffled."""
    plain = ["click_id", "client_id", "value"]
    whole = [F.sha2(F.col(f"`{c}`").cast("binary"), 256).alias(f"__{k}") if kind == "string" else F.col(f"`{c}`").alias(f"__{k}") if kind in ("bigint", "int", "double", "timestamp_ntz", "timestamp") else F.sha2(F.to_json(F.struct(F.col(f"`{c}`"))), 256).alias(f"__{k}") for k, (c, kind) in enumerate(clicks.dtypes) if c not in plain and c not in ("ts", "arrived_at", "kind")]
    rows = clicks.select(*plain, micros(clicks, "ts").alias("ts"), micros(clicks, "arrived_at").alias("arrived"), "kind", *whole).where("client_id IS NOT NULL AND ts IS NOT NULL AND arrived IS NOT NULL").distinct()
    bought = F.coalesce(F.col("kind") == "purchase", F.lit(False)).cast("bigint")
    return _event(rows, CLICK, client=F.col("client_id"), ts=F.col("ts"), start=F.greatest("ts", F.col("arrived") + DELAY), id=F.col("click_id"), cents=cents("value"), n=bought)


def line_events(lines: DataFrame, sales: DataFrame) -> DataFrame:
    """sales: as events. Lines of the sales that hold very many are dealt out, with as many copies of the sale."""
    rows = lines.select("sale_id", "item_id", micros(lines, "shipped_at").alias("shipped"), cents("amount").alias("cents"), "line_no").where("sale_id IS NOT NULL AND shipped IS NOT NULL")
    many = [k for k in (rows.select("sale_id").freqItems(["sale_id"], 0.001).first() or [[]])[0] or [] if k is not None]
    salted = lambda key: key.isin(many) if many else F.lit(False)
    rows = rows.withColumn("salt", F.when(salted(F.col("sale_id")), F.pmod(F.xxhash64("item_id", "shipped", "cents", "line_no"), F.lit(SALTS))).otherwise(0).cast("int"))
    last = F.when(salted(F.col("id")), SALTS - 1).otherwise(0)
    owners = sales.where("start IS NOT NULL").select(F.col("id").alias("sale_id"), "client", "ts", F.col("start").alias("since"), F.explode(F.sequence(F.lit(0), last)).alias("salt"))
    return _event(rows.join(owners, ["sale_id", "salt"]), LINE, client=F.col("client"), ts=F.col("ts"), start=F.greatest("since", "shipped"), cents=F.col("cents"), item=F.col("item_id"))


def _slot(time: Column) -> Column:
    return F.floor((time - F.col("origin")) / F.col("width")).cast("int")


def busy_clients(events: DataFrame, limit: int) -> DataFrame:
    """client, origin, width of those with more than limit events (more where that would be over MOST clients)."""
    limit = max(limit, (events.count() // MOST))
    spans = events.groupBy("client").agg(F.count("*").alias("rows"), F.min(F.least("ts", "start")).alias("least"), F.max(F.greatest("ts", "start")).alias("most")).where(F.col("rows") > limit)
    origin, span = F.col("least") - HORIZON, F.col("most") - F.col("least") + HORIZON + 18 * DAY
    return spans.select("client", origin.alias("origin"), F.ceil(span / F.ceil(F.col("rows") / limit)).cast("bigint").alias("width"))


def unioned(lines: DataFrame) -> DataFrame:
    """Lines of busy clients, summed up by time: prior is the ts up to whose expiry others cover the item, n the lines, item the number
    of items that the lines add. The latest ts of the slots before stands in each slot as a row in front of all others."""
    rows = lines.groupBy("client", "origin", "width", "item", "ts", "start").agg(F.sum("n").alias("n"), F.sum("cents").alias("cents")).withColumn("slot", _slot(F.col("start")))
    own = Window.partitionBy("client", "item", "slot").orderBy("start", "ts").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("client", "item").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    known = rows.where("item IS NOT NULL")
    before = known.groupBy("client", "item", "slot").agg(F.max("ts").alias("ts")).withColumn("ts", F.max("ts").over(over)).where("ts IS NOT NULL").withColumn("start", F.lit(LEAST))
    covered = known.unionByName(before, allowMissingColumns=True).withColumn("prior", F.max("ts").over(own)).where(F.col("start") > LEAST)
    covered = covered.unionByName(rows.where("item IS NULL"), allowMissingColumns=True)
    adds = F.col("item").isNotNull() & (F.col("prior").isNull() | (F.col("ts") > F.col("prior")))
    matters = adds & (F.col("prior") + max(WINDOWS) * DAY > F.col("start"))
    return covered.select("client", "origin", "width", "ts", "start", F.when(matters, F.col("prior")).alias("prior"), "n", "cents", adds.cast("bigint").alias("item")).groupBy("client", "origin", "width", "ts", "start", "prior").agg(*[F.sum(c).alias(c) for c in ("n", "cents", "item")])


POINT = [f"{kind}{d}" for kind in "vi" for d in WINDOWS] + ["label"]


def _points() -> list[dict[str, Column]]:
    """Where an event makes a difference (at, null if it does not), and what: v, i (items) for each window, label."""
    lives = {d: F.coalesce(F.col("start") < F.col("ts") + d * DAY, F.lit(False)) for d in WINDOWS}
    items = F.when(F.col("kind") == LINE, F.coalesce("item", F.lit(0))).otherwise(0)
    points = [{"at": F.col("start")} | {f"v{d}": lives[d].cast("int") for d in WINDOWS}]
    for d in WINDOWS:
        points.append({"at": F.when(lives[d], F.col("ts") + d * DAY), f"v{d}": F.lit(-1), f"i{d}": -items})
        points.append({"at": F.when(lives[d] & (items > 0), F.greatest("start", F.col("prior") + d * DAY)), f"i{d}": items})
    sale = F.col("kind") == SALE
    return [*points, {"at": F.when(sale, F.col("ts") - HORIZON), "label": F.lit(1)}, {"at": F.when(sale, F.col("ts")), "label": F.lit(-1)}, {"at": F.col("at")}]


def _summed(df: DataFrame, keys: list[str], order: str, sums: list[str]) -> DataFrame:
    """keys, order, with sums (and latest, a maximum) over the rows before, within blocks of BLOCK and over the blocks before."""
    before = (Window.unboundedPreceding, -1)
    df = df.withColumn("block", F.floor(F.col(order) / BLOCK))
    own, over = Window.partitionBy(*keys, "block").orderBy(order).rowsBetween(*before), Window.partitionBy(*keys).orderBy("block").rowsBetween(*before)
    blocks = df.groupBy(*keys, "block").agg(*[F.sum(c).alias(c) for c in sums], F.max("latest").alias("latest"))
    blocks = blocks.select(*keys, "block", *[F.coalesce(F.sum(c).over(over), F.lit(0)).alias(f"{c}_over") for c in sums], F.max("latest").over(over).alias("latest_over"))
    rows = df.select(*keys, order, "block", *[F.coalesce(F.sum(c).over(own), F.lit(0)).alias(c) for c in sums], F.max("latest").over(own).alias("latest")).join(blocks, [*keys, "block"])
    return rows.select(*keys, order, *[(F.col(c) + F.col(f"{c}_over")).alias(c) for c in sums], F.greatest("latest", "latest_over").alias("latest"))


def based(busy: DataFrame) -> DataFrame:
    """client, slot, low, high, kind (BASE), base, ts, id: what each chunk of busy clients has to begin with. busy: their events, with
    origin and width, their lines as unioned() gives them."""
    points = [busy.select("client", "origin", "width", "kind", "ts", "start", "id", "cents", "n", p["at"].alias("p_at"), *[p.get(name, F.lit(0)).cast("bigint").alias(name) for name in POINT]).where("p_at IS NOT NULL") for p in _points()]
    every = reduce(DataFrame.unionByName, points).withColumn("slot", _slot(F.col("p_at")))
    click, sale, line = (F.col("kind") == k for k in (CLICK, SALE, LINE))
    parts = []
    for d in WINDOWS:
        v = F.col(f"v{d}")
        for name, where, value in zip(SUMS, (click, click, click, sale, sale, line, line, line), (v, v * F.col("n"), v * F.col("cents"), v, v * F.col("cents"), v * F.col("n"), v * F.col("cents"), F.col(f"i{d}"))):
            parts.append(F.sum(F.when(where, value).otherwise(0)).alias(f"{name}_{d}"))
    parts.append(F.sum("label").alias("label"))
    latest = F.max(F.when(click & (F.col("p_at") == F.col("start")), F.struct("ts", "id"))).alias("latest")
    sums = [f"{name}_{d}" for d in WINDOWS for name in SUMS] + ["label"]
    bases = _summed(every.groupBy("client", "origin", "width", "slot").agg(*parts, latest), ["client", "origin", "width"], "slot", sums)
    return bases.select("client", "slot", *_bounds(), F.array(*sums).alias("base"), F.lit(BASE).alias("kind"), F.col("latest.ts").alias("ts"), F.col("latest.id").alias("id"))


def _bounds() -> list[Column]:
    begin = F.col("origin") + F.col("slot") * F.col("width")
    return [F.coalesce(begin, F.lit(LEAST)).alias("low"), F.coalesce(begin + F.col("width"), F.lit(GREATEST)).alias("high")]


def dealt(events: DataFrame) -> DataFrame:
    """Each event for each chunk that it makes a difference in: client, slot, low, high, event, base. Most clients have one chunk."""
    touched = F.array_distinct(F.array_compact(F.array(*[_slot(p["at"]) for p in _points()])))
    slots = F.when(F.col("width").isNull(), F.array(F.lit(0))).otherwise(touched)
    return events.withColumn("slot", F.explode(slots)).select(*COLUMNS, "slot", *_bounds(), F.lit(None).cast("array<bigint>").alias("base"))


class Buffer:
    """Rows of some chunks as numpy arrays; nulls as LEAST."""

    def __init__(self, rows: pa.Table):
        self.rows = rows
        get = lambda name: rows.column(name).cast(pa.int64()).fill_null(LEAST).to_numpy()
        for name in (*COLUMNS, "slot", "low", "high"):
            setattr(self, name, get(name))
        new = np.ones(len(self.client), bool)
        new[1:] = (self.client[1:] != self.client[:-1]) | (self.slot[1:] != self.slot[:-1])
        self.first = np.flatnonzero(new)
        self.chunk = np.cumsum(new) - 1
        times = [x[x > LEAST] for x in (self.ts, self.start, self.at)]
        times = np.concatenate([x for x in times if len(x)] or [np.zeros(1, np.int64)])
        self.origin = int(times.min()) - max(*WINDOWS, HORIZON // DAY) * DAY - 1
        self.span = int(times.max()) + max(WINDOWS) * DAY + 1 - self.origin

    def fits(self) -> bool:
        return len(self.first) * self.span < 1 << 62

    def key(self, at: np.ndarray, time: np.ndarray) -> np.ndarray:
        return self.chunk[at] * self.span + (time - self.origin)

    def bases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each chunk: its base, the time and id of its latest click (LEAST if none)."""
        base = np.zeros((len(self.first), len(WINDOWS) * len(SUMS) + 1), np.int64)
        ts, ids = np.full(len(self.first), LEAST), np.full(len(self.first), LEAST)
        own = np.flatnonzero(self.kind == BASE)
        if len(own):
            chunk = self.chunk[own]
            base[chunk] = self.rows.column("base").combine_chunks().take(pa.array(own)).flatten().to_numpy().reshape(len(own), -1)
            ts[chunk], ids[chunk] = self.ts[own], self.id[own]
        return base, ts, ids

    def priors(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each line the latest ts of lines of its client and item that started before (LEAST if none), and the items that it adds.
        Lines of chunks that are one of several have both already."""
        prior, adds = self.prior[lines].copy(), np.where(self.item[lines] > LEAST, self.item[lines], 0)
        own = np.flatnonzero(self.low[lines] == LEAST)
        if len(own):
            at = lines[own]
            order = np.lexsort((self.ts[at], self.start[at], self.item[at], self.chunk[at]))
            at = at[order]
            new = np.ones(len(at), bool)
            new[1:] = (self.item[at][1:] != self.item[at][:-1]) | (self.chunk[at][1:] != self.chunk[at][:-1])
            values, rank = np.unique(self.ts[at], return_inverse=True)
            group = np.cumsum(new).astype(np.int64)
            latest = np.maximum.accumulate((group << 32) | (rank + 1))
            before = np.concatenate(([0], latest[:-1]))
            before = np.where(new, 0, before & 0xFFFFFFFF)
            found = np.where(before > 0, values[np.maximum(before - 1, 0)], LEAST)
            prior[own[order]] = found
            adds[own[order]] = (self.item[at] > LEAST) & (self.ts[at] > found)
        return prior, adds

    def tally(self, asked: np.ndarray, rows: np.ndarray, points: np.ndarray, carried: list[np.ndarray]) -> list[np.ndarray]:
        """At each moment asked for, the sums of what is carried by the points of its chunk up to then."""
        own = (points >= self.low[rows]) & (points < self.high[rows])
        keys = self.key(rows[own], points[own])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        to, since = np.searchsorted(keys, self.key(asked, self.at[asked]), "right"), np.searchsorted(keys, self.chunk[asked] * self.span, "left")
        sums = [np.concatenate(([0], np.cumsum(c[own][order]))) for c in carried]
        return [s[to] - s[since] for s in sums]

    def difference(self, asked: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, carried: list[np.ndarray]) -> list[np.ndarray]:
        """What has started less what has expired."""
        lives = starts < ends
        rows, starts, ends, carried = rows[lives], starts[lives], ends[lives], [c[lives] for c in carried]
        return [a - b for a, b in zip(self.tally(asked, rows, starts, carried), self.tally(asked, rows, ends, carried))]

    def latest(self, asked: np.ndarray, clicks: np.ndarray, ts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Time and id of the latest click that has started, of those of the chunk or its base (ts, ids)."""
        clicks = clicks[(self.start[clicks] >= self.low[clicks]) & (self.start[clicks] < self.high[clicks])]
        keys = self.key(clicks, self.start[clicks])
        order = np.argsort(keys, kind="stable")
        clicks, keys = clicks[order], keys[order]
        by_age = np.lexsort((self.id[clicks], self.ts[clicks]))
        rank = np.empty(len(clicks), np.int64)
        rank[by_age] = np.arange(len(clicks))
        best = np.maximum.accumulate((self.chunk[clicks] << 32) | rank) & 0xFFFFFFFF
        to, since = np.searchsorted(keys, self.key(asked, self.at[asked]), "right"), np.searchsorted(keys, self.chunk[asked] * self.span, "left")
        has = to > since
        found = clicks[by_age[best[to[has] - 1]]]
        time, own = ts[self.chunk[asked]].copy(), ids[self.chunk[asked]].copy()
        better = (self.ts[found] > time[has]) | ((self.ts[found] == time[has]) & (self.id[found] > own[has]))
        at = np.flatnonzero(has)[better]
        time[at], own[at] = self.ts[found[better]], self.id[found[better]]
        return time, own

    def features(self) -> list[pa.RecordBatch]:
        asked = np.flatnonzero((self.kind == SALE) & (self.at >= self.low) & (self.at < self.high))
        base, ts, ids = self.bases()
        base = base[self.chunk[asked]]
        sales, clicks, lines = (np.flatnonzero((self.kind == k) & (self.start > LEAST)) for k in (SALE, CLICK, LINE))
        prior, adds = self.priors(lines)
        every = np.flatnonzero(self.kind == SALE)
        label = self.difference(asked, every, self.ts[every] - HORIZON, self.ts[every], [self.n[every]])[0] + base[:, -1] > 0
        time, last = self.latest(asked, clicks, ts, ids)
        out = []
        for k, d in enumerate(WINDOWS):
            end = lambda rows: self.ts[rows] + d * DAY  # noqa: B023, E731
            found = self.difference(asked, clicks, self.start[clicks], end(clicks), [np.ones(len(clicks), np.int64), self.n[clicks], self.cents[clicks]])
            found += self.difference(asked, sales, self.start[sales], end(sales), [self.n[sales], self.cents[sales]])
            found += self.difference(asked, lines, self.start[lines], end(lines), [self.n[lines], self.cents[lines]])
            covered = np.where(prior > LEAST, prior + d * DAY, LEAST)
            found += self.difference(asked, lines, np.where(adds > 0, np.maximum(self.start[lines], covered), GREATEST), end(lines), [adds])
            named = {name: x + base[:, k * len(SUMS) + j] for j, (name, x) in enumerate(zip(SUMS, found))}
            fresh = (time > self.at[asked] - d * DAY) & (last > LEAST)
            out.append(
                pa.record_batch(
                    [pa.array(self.id[asked], mask=self.id[asked] == LEAST), pa.array(np.full(len(asked), d, np.int32)), pa.array(self.at[asked]), pa.array(label), pa.array(last, mask=~fresh), *map(pa.array, named.values())],
                    names=["sale_id", "d", "t_us", "label", "last_click_id", *named],
                )
            )
        return out


def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature rows of chunks, which come one after another; a few hundred thousand rows are held at a time, a chunk at least."""

    def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        held = Buffer(rows)
        if held.fits() or len(held.first) == 1:
            yield from held.features()
        else:
            half = int(held.first[len(held.first) // 2])
            yield from done(rows.slice(0, half))
            yield from done(rows.slice(half))

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= BUFFER:
            rows = pa.Table.from_batches(waiting).combine_chunks()
            cut = int(Buffer(rows).first[-1])
            if cut:
                yield from done(rows.slice(0, cut))
                waiting = pa.Table.from_batches(rows.slice(cut).to_batches()).combine_chunks().to_batches()
    if waiting:
        yield from done(pa.Table.from_batches(waiting).combine_chunks())


OUT = "sale_id bigint, d int, t_us bigint, label boolean, last_click_id bigint, " + ", ".join(f"{name} bigint" for name in SUMS)


def features(sales: DataFrame, lines: DataFrame, clicks: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Two rows for each sale with a client and a time: sale_id, d (days of the window), t_us (the moment), label, the features."""
    with passing(sales.sparkSession) as keep:
        sold = sale_events(sales)
        events = stored(sold.unionByName(click_events(clicks)).unionByName(line_events(lines, sold)), "events")
        busy = stored(busy_clients(events, limit), "busy")
        keep(events, busy)
    if busy.isEmpty():
        rows = dealt(events.withColumns({"origin": F.lit(None).cast("bigint"), "width": F.lit(None).cast("bigint")}))
    else:
        # an event has one row in the join, with or without chunks; the kind keeps the join an outer one whatever is asked of it
        marked = events.join(small(busy), "client", "left")
        cut, line = F.when(F.col("kind") >= 0, F.col("width")).isNotNull(), F.col("kind") == LINE
        lines = stored(unioned(stored(marked.where(cut & line), "busy_lines")).withColumn("kind", F.lit(LINE)), "unioned")
        rest = stored(marked.where(cut & ~line), "busy_events")  # read by each kind of point
        bases = stored(based(rest.unionByName(lines, allowMissingColumns=True)), "bases")
        rows = dealt(marked.where(~(cut & line)).unionByName(lines, allowMissingColumns=True)).unionByName(bases, allowMissingColumns=True)
    return rows.repartition("client", "slot").sortWithinPartitions("client", "slot").mapInArrow(tidied(computed), OUT)


def _sql_sum(amount: str, where: str) -> str:
    return f"coalesce(sum(floor(100 * {amount} + 0.5)::BIGINT) FILTER ({where}), 0)::BIGINT"


_KNOWN = "{0} > s.t - to_days(d) AND {0} <= s.t AND {1} + INTERVAL 240 MINUTE <= s.t"

ORACLE = f"""
WITH {CRC_TABLE}, w(d) AS (VALUES (2), (14)),
s AS (SELECT sales.*, row_number() OVER () AS r, sold_at + to_seconds(({CRC.format('sale_id')} % {JITTER})::BIGINT) AS t FROM sales, crc WHERE client_id IS NOT NULL AND sold_at IS NOT NULL),
c AS (SELECT DISTINCT * FROM clicks),
a AS (SELECT s.r, d, count(*) AS n_clicks, count(*) FILTER (kind = 'purchase') AS n_purchases, {_sql_sum('value', 'true')} AS click_cents, arg_max(click_id, (c.ts, coalesce(click_id, -1))) AS last_click_id
      FROM s, w, c WHERE c.client_id = s.client_id AND {_KNOWN.format('c.ts', 'c.arrived_at')} GROUP BY s.r, d),
e AS (SELECT s.r, d, o.r AS own, o.sale_id, o.total, s.t FROM s, w, s o WHERE o.client_id = s.client_id AND {_KNOWN.format('o.sold_at', 'o.arrived_at')}),
b AS (SELECT r, d, count(*) AS n_sales, {_sql_sum('total', 'true')} AS sale_cents FROM e GROUP BY r, d),
l AS (SELECT r, d, count(*) AS n_lines, count(DISTINCT item_id) AS n_items, {_sql_sum('amount', 'true')} AS line_cents FROM e JOIN sale_lines l USING (sale_id) WHERE shipped_at <= t GROUP BY r, d),
g AS (SELECT DISTINCT s.r FROM s JOIN s o ON o.client_id = s.client_id AND o.sold_at > s.t AND o.sold_at <= s.t + to_days(7))
SELECT s.sale_id, w.d, epoch_us(s.t) AS t_us, g.r IS NOT NULL AS label, last_click_id,
       {", ".join(f"coalesce({n}, 0)::BIGINT AS {n}" for n in SUMS)}
FROM s CROSS JOIN w LEFT JOIN a ON a.r = s.r AND a.d = w.d LEFT JOIN b ON b.r = s.r AND b.d = w.d LEFT JOIN l ON l.r = s.r AND l.d = w.d LEFT JOIN g ON g.r = s.r
"""
