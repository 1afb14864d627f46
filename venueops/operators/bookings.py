"""Tables and their reservations: conflicts, admission of a batch of requests, free tables.

A reservation takes its table for the half-open span [start, start + duration). Spans are full
timestamps, so a booking past midnight also meets those of the next day.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from venueops.functions.columns import Moment, full_name, keyed, moment, span_end
from venueops.functions.ordered import numbered, running
from venueops.plans.session import checkpointed

# Names of the statuses of orders that no longer hold a table.
CLOSED = ("Завершён", "Отменён")

PIECE_ROWS = 50_000  # requests that are decided by one task
ACCEPTED, REJECTED, WAITING = 1, 0, -1


def with_span(reservations: DataFrame) -> DataFrame:
    """Adds ``start_at`` and ``end_at`` from date, time of day and duration."""
    start = F.concat(F.col("reservation_date").cast("string"), F.lit(" "), F.col("reservation_time"))
    return reservations.withColumn("start_at", start.cast("timestamp_ntz")).withColumn(
        "end_at", span_end(F.col("start_at"), F.col("duration_minutes"))
    )


def free_resources_at(
    tables: DataFrame,
    reservations: DataFrame,
    dine_ins: DataFrame,
    orders: DataFrame,
    statuses: DataFrame,
    as_of: Moment,
    same_day: bool = True,
    closed: tuple[str, ...] = CLOSED,
) -> DataFrame:
    """Available tables that are neither reserved at ``as_of`` nor held by an open order of that day.

    ``reservations`` carry ``start_at`` and ``end_at``. With ``same_day`` only reservations that
    start on the day of ``as_of`` count.
    """
    now = moment(as_of)
    day = F.date_trunc("day", now).cast("timestamp_ntz")
    active = (F.col("start_at") <= now) & (F.col("end_at") > now)
    if same_day:
        active = active & (F.col("start_at") >= day)
    reserved = reservations.filter(active).select(F.col("table_id").alias("id")).distinct()

    over = statuses.filter(F.col("name").isin(*closed)).select(F.col("id").alias("status_id"))
    open_orders = (
        orders.filter((F.col("created_at") >= day) & (F.col("created_at") <= now))
        .join(over, "status_id", "left_anti")
        .select(F.col("id").alias("order_id"))
    )
    held = (
        dine_ins.select("order_id", F.col("table_id").alias("id"))
        .join(open_orders, "order_id", "left_semi")
        .select("id")
        .distinct()
    )
    return (
        tables.filter("is_available")
        .join(reserved, "id", "left_anti")
        .join(held, "id", "left_anti")
        .select("number", "capacity", "location")
        .orderBy("capacity", "number")
    )


def reservation_conflicts(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """Adds ``conflicts``: how many existing reservations of the same table overlap the request.

    Overlapping spans start before the request ends and end after it starts. Rows without a table, a start or
    an end meet nothing. ``request_id`` is unique in the requests, ``id`` in the existing reservations. Spans that
    end before they start are compared as they are written, by a join; all others on the time line.
    """
    known = F.col("table_id").isNotNull() & F.col("start_at").isNotNull() & F.col("end_at").isNotNull()
    backwards = F.col("end_at") < F.col("start_at")
    held, asked = existing.filter(known), requests.filter(known)
    parts = (
        _on_the_time_line(asked.filter(~backwards), held.filter(~backwards))
        .unionByName(_by_pairs(asked.filter(backwards), held))
        .unionByName(_by_pairs(asked.filter(~backwards), held.filter(backwards)))
    )
    conflicts = parts.groupBy("request_id").agg(F.sum("conflicts").alias("conflicts"))
    return requests.join(conflicts, "request_id", "left").select(
        *requests.columns, F.coalesce("conflicts", F.lit(0)).cast("long").alias("conflicts")
    )


def conflict_rows(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """Each request's conflicts as rows: ``request_id`` and the columns of the existing reservation that overlaps it.

    The rule is that of :func:`reservation_conflicts`, whose counts these rows add up to. Spans are cut into time
    buckets as wide as spans are long on average, so that a popular table is spread over its buckets; a pair comes out
    once, in the bucket where the later of the two starts. Rows without a table, a start or an end meet nothing. A
    ``request_id`` among the columns of ``existing`` is replaced.
    """
    known = F.col("table_id").isNotNull() & F.col("start_at").isNotNull() & F.col("end_at").isNotNull()

    def second(column: str):  # of a timestamp without zone
        day, *parts = F.unix_date(F.col(column).cast("date")), F.hour(column), F.minute(column), F.second(column)
        return day.cast("long") * 86400 + parts[0] * 3600 + parts[1] * 60 + parts[2]

    length = (second("end_at") - second("start_at")).alias("s")
    lengths = requests.filter(known).select(length).unionByName(existing.filter(known).select(length))
    mean = lengths.filter("s > 0").agg(F.avg("s").alias("s")).first()["s"]
    width = max(60, int(mean or 0))

    def bucket(column: str):
        return F.floor(second(column) / width).cast("long")

    def spread(df: DataFrame):
        until = F.greatest(bucket("start_at"), bucket("end_at"))
        return df.filter(known).withColumn("_bucket", F.explode(F.sequence(bucket("start_at"), until)))

    asked = spread(requests.select("request_id", "table_id", "start_at", "end_at"))
    asked = asked.withColumnsRenamed({"start_at": "_from", "end_at": "_to"})
    held = spread(existing.drop("request_id"))
    later = F.greatest(bucket("_from"), bucket("start_at"))
    return (
        asked.join(held, ["table_id", "_bucket"])
        .filter((F.col("start_at") < F.col("_to")) & (F.col("end_at") > F.col("_from")) & (F.col("_bucket") == later))
        .select("request_id", *[c for c in existing.columns if c != "request_id"])
    )


def _by_pairs(requests: DataFrame, existing: DataFrame) -> DataFrame:
    spans = existing.select("table_id", F.col("start_at").alias("_from"), F.col("end_at").alias("_to"))
    met = requests.join(spans, "table_id").filter((F.col("_from") < F.col("end_at")) & (F.col("_to") > F.col("start_at")))
    return met.groupBy("request_id").agg(F.count(F.lit(1)).alias("conflicts"))


def _on_the_time_line(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """(request_id, conflicts): spans that start before the request ends, less those that end by the time it starts.
    Both numbers are running counts along the table's time line, so no pair of reservations is ever formed."""
    no_length = F.col("start_at") == F.col("end_at")

    def moments(*pairs):
        return F.explode(F.array(*[F.struct(F.col(c).alias("at"), t.alias("turn")) for c, t in pairs]))

    # At one instant the turns are: ends, request starts, request ends, starts. Spans of no length
    # end later than others, so as not to be subtracted from requests of no length at that instant.
    held = existing.select(
        "table_id",
        "id",
        moments(("end_at", F.when(no_length, 2).otherwise(0)), ("start_at", F.lit(5))).alias("m"),
    )
    asked = requests.select(
        "table_id",
        "request_id",
        moments(("start_at", F.when(no_length, 1).otherwise(3)), ("end_at", F.lit(4))).alias("m"),
    )
    timeline = (
        held.unionByName(asked, allowMissingColumns=True)
        .select("table_id", "id", "request_id", "m.at", "m.turn")
        .withColumns(
            {
                "started": F.when(F.col("turn") == 5, 1),
                "ended": F.when(F.col("turn").isin(0, 2), 1),
            }
        )
    )
    # rows of one turn at one instant count alike; the ids only make the order total
    timeline = timeline.withColumn("_tie", F.xxhash64("request_id", "id"))
    counted = running(
        timeline,
        ["table_id"],
        ["at", "turn", "_tie"],
        {"started_by": ("count", "started"), "ended_by": ("count", "ended")},
    )
    return (
        counted.filter(F.col("request_id").isNotNull())
        .groupBy("request_id")
        .agg(
            F.sum(
                F.when(F.col("turn") == 4, F.col("started_by")).otherwise(-F.col("ended_by"))
            ).alias("conflicts")
        )
    )


def admit_reservations(requests: DataFrame, existing: DataFrame, tables: DataFrame) -> DataFrame:
    """Decides a batch of requests as if they came one by one, in the order (``arrival``, ``request_id``).

    A request is accepted if its table is available and its span meets neither an existing
    reservation nor a request accepted before it. All requests come back, with ``accepted``.
    """
    open_tables = tables.filter("is_available").select(F.col("id").alias("table_id"))
    possible = requests.join(open_tables, "table_id", "left_semi")
    free = reservation_conflicts(possible, existing).filter("conflicts = 0")
    accepted, _ = first_come(free.select("request_id", "table_id", "start_at", "end_at", "arrival"))
    accepted = accepted.withColumn("accepted", F.lit(True))
    return requests.join(accepted, "request_id", "left").select(
        *requests.columns, F.coalesce("accepted", F.lit(False)).alias("accepted")
    )


def first_come(requests: DataFrame) -> tuple[DataFrame, int]:
    """(``request_id`` of the accepted requests, number of rounds), decided by local precedence.

    A request is decided once all requests are that arrived before it and overlap it. The tables' time lines are cut
    into pieces of about ``PIECE_ROWS`` requests, wherever a table is that popular. A task decides a piece in order
    of arrival; what could meet an earlier request of another piece waits, as does what meets a waiting one.
    The next round cuts only the waiting requests, which are few unless overlaps run through many pieces in
    order of arrival. The accepted spans that reach into later pieces, at most one for each cut, are told to them.

    Requests without a table, a start or an end meet nothing and are accepted. Spans without a length, or that end
    before they start, meet what contains them.
    """
    spark = requests.sparkSession
    known = F.col("table_id").isNotNull() & F.col("start_at").isNotNull() & F.col("end_at").isNotNull()
    accepted = [requests.filter(~known).select("request_id")]
    waiting = numbered(requests.filter(known), ["arrival", "request_id"], "turn").select(
        "request_id", "table_id", "start_at", "end_at", "turn"
    )
    reached: list[tuple] = []  # spans accepted in the round before that reach into later pieces
    rounds, number = 0, waiting.count()
    while number:
        rounds += 1
        count = -(-number // PIECE_ROWS)
        ranged = waiting.repartitionByRange(count, "table_id", "start_at", "end_at", "turn")
        cut = checkpointed(ranged.withColumn("piece", F.spark_partition_id()))
        edges = _edges(cut) if count > 1 else None
        decided = checkpointed(_decided(cut, count, edges, reached))
        taken = decided.filter(F.col("status") == ACCEPTED)
        accepted.append(taken.select("request_id"))
        waiting = decided.filter(F.col("status") == WAITING)
        if edges is not None:
            reached = [tuple(r) for r in taken.filter("crosses").select("table_id", "start_at", "end_at").collect()]
            met = _met_beyond(waiting.filter("crosses"), taken, edges)
            waiting = checkpointed(waiting.join(met, "request_id", "left_anti"))
        waiting = waiting.drop("status", "crosses", "piece")
        number = waiting.count()
    result = accepted[0]
    for more in accepted[1:]:
        result = result.unionByName(more)
    return result, rounds


def _edges(cut: DataFrame) -> DataFrame:
    """For each piece of a table that has several: its first start and turn, the next piece's first start, and of the
    spans that reach there the first turn and the last end. A cut lies in one table, so there are at most two a piece."""
    spread = cut.groupBy("table_id", "piece").agg(F.min("start_at").alias("first"), F.min("turn").alias("turn"))
    by_piece = Window.partitionBy("table_id").orderBy("piece")
    spread = spread.withColumns(
        {"next": F.lead("first").over(by_piece), "before": F.lag("first").over(by_piece)}
    ).filter("next is not null or before is not null")
    spread = checkpointed(spread.drop("before"))
    crossing = (
        cut.join(F.broadcast(spread.select("table_id", "piece", "next")), ["table_id", "piece"])
        .filter(F.col("end_at") > F.col("next"))
        .groupBy("table_id", "piece")
        .agg(F.min("turn").alias("cross_turn"), F.max("end_at").alias("reach"))
    )
    return checkpointed(spread.join(crossing, ["table_id", "piece"], "left"))


def _met_beyond(crossing: DataFrame, taken: DataFrame, edges: DataFrame) -> DataFrame:
    """``request_id`` of the waiting spans ``crossing`` into later pieces that meet a span accepted there."""
    reach = crossing.groupBy("table_id", "piece").agg(F.max("end_at").alias("until"))  # a row per cut at most
    beyond = edges.join(reach, ["table_id", "piece"]).select(F.col("table_id").alias("of"), "next", "until")
    there = (F.col("table_id") == F.col("of")) & (F.col("start_at") >= F.col("next")) & (F.col("start_at") < F.col("until"))
    near = taken.join(F.broadcast(beyond), there, "left_semi").withColumnRenamed("request_id", "id")
    return reservation_conflicts(crossing, near).filter("conflicts > 0").select("request_id")


class _Spans:
    """Spans that only grow in number, asked whether one of them meets another span."""

    def __init__(self, ends: list):
        self.ends = sorted(set(ends))
        # the least start among the spans of the greatest ends: a tree of minima over ends, greatest first
        self.least: list = [None] * (len(self.ends) + 1)

    def add(self, start, end) -> None:
        k = len(self.ends) - bisect_left(self.ends, end)
        while k < len(self.least):
            if self.least[k] is None or start < self.least[k]:
                self.least[k] = start
            k += k & -k

    def meets(self, start, end) -> bool:
        k = len(self.ends) - bisect_right(self.ends, start)
        while k > 0:
            if self.least[k] is not None and self.least[k] < end:
                return True
            k -= k & -k
        return False


def _decided(cut: DataFrame, count: int, edges: DataFrame | None, reached: list[tuple]) -> DataFrame:
    """``cut`` with ``status`` and whether a span ``crosses`` into a later piece of its table."""
    known: dict = {}  # of each table that several pieces share: their edges, in order
    for row in edges.orderBy("piece").collect() if edges is not None else []:
        known.setdefault(row["table_id"], []).append(row.asDict())
    told: dict = {}
    for table, start, end in reached:
        told.setdefault(table, []).append((start, end))

    def decide(table, piece, rows: list[tuple]) -> Iterator[tuple]:
        begin = min(r[1] for r in rows)
        mine = known.get(table, [])
        earlier = [e for e in mine if e["piece"] < piece and e["reach"] is not None and e["reach"] > begin]
        later = [e for e in mine if e["piece"] > piece]
        border = later[0]["first"] if later else None
        held = told.get(table, [])
        ends = [r[2] for r in rows] + [e for _, e in held]
        taken, open_ = _Spans(ends), _Spans(ends)
        for start, end in held:
            taken.add(start, end)
        for request, start, end, turn in rows:
            crosses = border is not None and end > border
            if taken.meets(start, end):
                status = REJECTED
            elif (
                open_.meets(start, end)
                or any(e["reach"] > start and e["cross_turn"] < turn for e in earlier)
                or (crosses and any(e["turn"] < turn for e in takewhile(lambda e: e["first"] < end, later)))
            ):
                status = WAITING
                open_.add(start, end)
            else:
                status = ACCEPTED
                taken.add(start, end)
            yield request, table, start, end, turn, piece, status, crosses

    columns = ["request_id", "table_id", "start_at", "end_at", "turn", "piece"]
    placed = cut.select(*columns).repartition(count, "piece").sortWithinPartitions("piece", "table_id", "turn")
    schema = StructType([*placed.schema.fields]).add("status", "integer").add("crosses", "boolean")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(schema)

        def packed(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

        group, rows, found = None, [], []
        for batch in batches:
            for request, table, start, end, turn, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group != (table, piece):
                    if rows:
                        found += decide(*group, rows)
                    if len(found) >= 10_000:
                        yield packed(found)
                        found = []
                    group, rows = (table, piece), []
                rows.append((request, start, end, turn))
        if rows:
            found += decide(*group, rows)
        if found:
            yield packed(found)

    return placed.mapInArrow(each, schema)


def reservation_confirmations(reservations: DataFrame, tables: DataFrame, employees: DataFrame) -> DataFrame:
    """What the guest is told: table, span, phone, and who took the reservation."""
    seats = keyed(
        tables, "table_id", table_number="number", table_capacity="capacity", table_location="location"
    )
    clerks = keyed(employees, "created_by_employee_id", created_by=full_name())
    return (
        reservations.join(seats, "table_id")
        .join(clerks, "created_by_employee_id")
        .select(
            F.col("id").alias("reservation_id"),
            "table_number",
            "table_capacity",
            "table_location",
            F.to_date("start_at").alias("reservation_date"),
            F.date_format("start_at", "HH:mm:ss").alias("reservation_time_start"),
            F.date_format("end_at", "HH:mm:ss").alias("reservation_time_end"),
            "customer_phone",
            "created_by",
        )
    )
