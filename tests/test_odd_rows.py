"""Rows that are legal and rare: reservations without a length or a time, spans that run backwards, large amounts."""

from __future__ import annotations

from venueops.operators.baskets import split_service_type
from venueops.operators.bookings import reservation_conflicts, with_span


def test_conflicts_equal_a_pair_loop(spark):
    rows = [
        (i, table, "2026-04-20", time, minutes)
        for i, (table, time, minutes) in enumerate(
            (t, h, m) for t in (1, 2, None) for h in ("10:00:00", "11:00:00", "12:30:00", None) for m in (None, -90, 0, 60, 180)
        )
    ]
    schema = "id int, table_id int, reservation_date string, reservation_time string, duration_minutes int"
    held = with_span(spark.createDataFrame(rows, schema))
    asked = held.withColumnRenamed("id", "request_id")
    got = {r.request_id: r.conflicts for r in reservation_conflicts(asked, held).collect()}
    spans = [(r.id, r.table_id, r.start_at, r.end_at) for r in held.collect()]
    assert all((s is None) == (rows[i][3] is None) for i, _, s, _ in spans)

    def meet(a, b):
        whole = None not in a[1:] and None not in b[1:]
        return whole and a[1] == b[1] and b[2] < a[3] and b[3] > a[2]

    assert got == {a[0]: sum(meet(a, b) for b in spans) for a in spans}


def test_an_address_of_zero_is_an_address(spark):
    rows = [("delivery", None, None, "0", 3), ("delivery", None, None, "", 3), ("delivery", None, None, "x", 0), ("dine_in", 1, 2, None, None)]
    frame = spark.createDataFrame(rows, "order_type string, table_id int, employee_id int, address string, courier_id int")
    assert [r.route for r in split_service_type(frame).collect()] == ["delivery", "rejected", "rejected", "hall"]
