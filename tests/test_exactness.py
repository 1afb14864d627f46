"""Batch operators against plain loops, with hot keys, ties, and every fallback forced."""

from __future__ import annotations

import itertools
import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bindings.views import Venue
from venueops.functions.ordered import PIECE, numbered, pieces, running
from venueops.functions import crowded
from venueops.operators import bookings, keys, loyalty, reports, routes

DAY = datetime(2026, 4, 20)


@pytest.fixture
def many_partitions(spark):
    """Keeps small shuffles apart, so that keys really are cut."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def hot(n, seed=7):
    """Rows of which a third share one key, with tied order values."""
    rng = random.Random(seed)
    return [(i, 1 if rng.random() < 0.34 else rng.randint(2, 40), rng.randint(0, 9), rng.randint(-5, 50))
            for i in range(n)]


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_equals_a_window(spark, many_partitions, inclusive):
    df = spark.createDataFrame(hot(3000), "id int, k int, o int, v int").repartition(5)
    cut = pieces(df, ["k"], ["o", "id"])
    assert cut.filter("k = 1").select(PIECE).distinct().count() > 1
    w = Window.partitionBy("k").orderBy("o", "id").rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    want = df.withColumns({"s": F.sum("v").over(w), "n": F.count("v").over(w), "m": F.max("v").over(w)})
    found = running(
        df, ["k"], ["o", "id"], {"s": ("sum", "v"), "n": ("count", "v"), "m": ("max", "v")}, inclusive
    )
    assert sorted(map(repr, found.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_numbers_follow_the_order_without_gaps(spark, many_partitions):
    df = spark.createDataFrame(hot(2000), "id int, k int, o int, v int").repartition(6)
    found = numbered(df, ["o", "id"], "n").orderBy("n").collect()
    assert [r.n for r in found] == list(range(1, 2001))
    assert [(r.o, r.id) for r in found] == sorted((r.o, r.id) for r in found)
    after = keys.surrogate_keys(df.select(F.col("id").alias("x"), "o"), ["o", "x"], df)
    assert (after.agg(F.min("id"), F.max("id")).first()) == (2000, 3999)
    empty = keys.surrogate_keys(df.select(F.col("id").alias("x")), ["x"], df.filter("false"))
    assert empty.agg(F.min("id")).first()[0] == 1


def test_overlay_writes_null_and_keeps_the_rest(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    patch = spark.createDataFrame([(1, None), (3, "c")], "id int, v string")
    assert sorted(map(tuple, keys.overlay(base, patch, "id", ["v"]).collect())) == [(1, None), (2, "b"), (3, "c")]
    changed = keys.overlay(base, patch, "id", ["v"], only_changed=True)
    assert sorted(map(tuple, changed.collect())) == [(1, None), (3, "c")]


TIERS = [(1, "one", "10", "5"), (2, "two", "100", "5"), (3, "three", "500", "10"), (4, "four", "500", "15")]


def _tiers(spark):
    return spark.createDataFrame(TIERS, "id int, name string, m string, c string").select(
        "id", "name", F.col("m").cast("decimal(10,2)").alias("min_spent"),
        F.col("c").cast("decimal(5,2)").alias("cashback_percent"),
    )


def _tier_of(spent):
    reached = [(Decimal(m), i) for i, _, m, _ in TIERS if Decimal(m) <= spent]
    return max(reached)[1] if reached else None


@pytest.mark.parametrize("scale, limit", [(2, 4096), (4, 4096), (2, 4), (4, 3)])
def test_tier_lookup(spark, many_partitions, monkeypatch, scale, limit):
    monkeypatch.setattr(loyalty, "TIERS_IN_ARRAY", limit)
    rng = random.Random(3)
    spent = [Decimal(rng.choice(["0", "9.99", "10", "99.99", "100", "499.99", "500", "9999", *["9.996"] * (scale > 2)])) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(spent)), f"id int, s decimal(18,{scale})")
    found = {r.id: r.reached_tier_id for r in loyalty.tier_reached(df, "s", _tiers(spark), "id").collect()}
    assert found == {i: _tier_of(s) for i, s in enumerate(spent)}


def test_many_tiers_and_rows_of_every_kind(spark):
    """All counts of thresholds around powers of two; nulls, equal thresholds, doubles beside decimals."""
    amounts = [None, -1.0, 0.0, 0.5, *range(1, 20), 1e9]
    df = spark.createDataFrame(list(enumerate(map(lambda x: None if x is None else float(x), amounts))), "id int, s double")
    for n in (0, 1, 2, 3, 4, 7, 8, 9, 17):
        tiers = [(i, Decimal(i // 2)) for i in range(n)] + [(99, None)]
        tier_df = spark.createDataFrame(tiers, "id int, min_spent decimal(10,2)")
        found = {r.id: r.reached_tier_id for r in loyalty.tier_reached(df, "s", tier_df, "id").collect()}
        for i, s in enumerate(amounts):
            reached = [(m, t) for t, m in tiers if m is not None and s is not None and m <= s]
            assert found[i] == (max(reached)[1] if reached else None)


def test_cashback_of_a_batch_equals_closing_one_by_one(spark, many_partitions):
    rng = random.Random(11)
    orders = [
        (i, None if rng.random() < 0.1 else (1 if rng.random() < 0.34 else rng.randint(2, 20)),
         DAY + timedelta(minutes=rng.randint(0, 30)), Decimal(rng.randint(1, 999)) / 100)
        for i in range(600)
    ]
    people = {c: (Decimal(rng.choice(["0", "8.5", "95", "400"])), rng.choice([None, 1, 2])) for c in range(1, 21)}
    rates = {i: Decimal(c) for i, _, _, c in TIERS}

    want = {}
    state = dict(people)
    for i, customer, _, cost in sorted(orders, key=lambda o: (o[2], o[0])):
        if customer is None:
            continue
        spent, tier = state[customer]
        spent += cost
        tier = _tier_of(spent) or tier
        state[customer] = (spent, tier)
        if tier:
            points = (cost * rates[tier] / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
            want[i] = (customer, points, tier)

    closed = spark.createDataFrame(
        orders, "id int, customer_id int, created_at timestamp_ntz, total_cost decimal(18,2)"
    )
    customers = spark.createDataFrame(
        [(c, s, t) for c, (s, t) in people.items()],
        "id int, total_spent decimal(18,2), last_achieved_tier_id int",
    ).withColumn("total_orders", F.lit(0))
    rows = loyalty.cashback_accrual(closed, customers, _tiers(spark)).collect()
    assert {r.order_id: (r.customer_id, r.points_amount, r.tier_id) for r in rows} == want

    rolled = loyalty.tier_assignment(loyalty.customer_rollup(customers, closed), _tiers(spark)).collect()
    assert {r.id: (r.total_spent, r.last_achieved_tier_id) for r in rolled} == state


def _baskets(orders):
    return [(o, i, 1) for o, items in orders.items() for i in items for _ in range(1 + (i % 5 == 0))]


@pytest.mark.parametrize("support", [1, 2, 3])
@pytest.mark.parametrize("giants", [0, 1, 4])
def test_pairs_with_orders_over_the_limit(spark, support, giants):
    rng = random.Random(giants)
    orders = {o: rng.sample(range(60), rng.randint(1, 6)) for o in range(150)}
    orders |= {1000 + g: rng.sample(range(60), 45) for g in range(giants)}
    lines = spark.createDataFrame(_baskets(orders), "order_id int, menu_item_id int, quantity int")
    items = spark.range(60).select(F.col("id").cast("int"), F.concat(F.lit("dish "), "id").alias("name"))
    want = Counter(pair for basket in orders.values() for pair in itertools.combinations(sorted(basket), 2))
    found = reports.copurchase_pairs(lines, items, support, order_limit=10).collect()
    assert {(r.item_1, r.item_2): r.count_of_joint_orders for r in found} == {
        pair: n for pair, n in want.items() if n >= support
    }
    assert len(found) == len({(r.item_1, r.item_2) for r in found})


def _spans(n, seed, longest, tables=6):
    """Bookings of which a third go to one table; some have no length, some share their instants."""
    rng = random.Random(seed)
    spans = []
    for i in range(n):
        table = 1 if rng.random() < 0.34 else rng.randint(2, tables)
        start = DAY + timedelta(minutes=15 * rng.randint(0, 200))
        spans.append((i, table, start, start + timedelta(minutes=15 * rng.randint(0, longest)), rng.randint(0, 50)))
    return spans


def _meet(a, b):
    return a[1] == b[1] and a[2] < b[3] and b[2] < a[3]


SPAN = "request_id int, table_id int, start_at timestamp_ntz, end_at timestamp_ntz, arrival int"


def test_conflict_counts_equal_comparing_all_pairs(spark, many_partitions):
    requests, held = _spans(250, 1, 6), _spans(250, 2, 6)
    found = bookings.reservation_conflicts(
        spark.createDataFrame(requests, SPAN),
        spark.createDataFrame(held, SPAN).withColumnRenamed("request_id", "id"),
    ).collect()
    assert {r.request_id: r.conflicts for r in found} == {
        r[0]: sum(_meet(r, h) for h in held) for r in requests
    }
    rows = bookings.conflict_rows(
        spark.createDataFrame(requests, SPAN),
        spark.createDataFrame(held, SPAN).withColumnRenamed("request_id", "id"),
    )
    assert rows.columns == ["request_id", "id", "table_id", "start_at", "end_at", "arrival"]
    assert sorted((r["request_id"], r["id"]) for r in rows.collect()) == sorted(
        (r[0], h[0]) for r in requests for h in held if _meet(r, h)
    )


def test_conflict_rows_of_odd_spans(spark):
    """Spans of no length, backward ones, nulls, one that lasts months; a request_id in the reservations."""
    at = [None, *(DAY + timedelta(hours=h) for h in (0, 1, 2, 30, 3000))]
    spans = [(t, a, b) for t in (1, None) for a in at for b in at]
    rows = [(i, *x, 0) for i, x in enumerate(spans)]
    df = spark.createDataFrame(rows, SPAN)
    found = bookings.conflict_rows(df, df.withColumn("id", F.col("request_id"))).collect()
    whole = [r for r in rows if None not in r]
    assert sorted((r["request_id"], r["id"]) for r in found) == sorted((a[0], b[0]) for a in whole for b in whole if _meet(a, b))
    none = df.limit(0)
    assert bookings.conflict_rows(none, none.withColumn("id", F.col("request_id"))).count() == 0


def _first_come(requests):
    taken, want = {}, set()
    for request in sorted(requests, key=lambda r: (r[4], r[0])):
        if not any(_meet(request, t) for t in taken.setdefault(request[1], [])):
            taken[request[1]].append(request)
            want.add(request[0])
    return want


@pytest.mark.parametrize("rows, seed, longest", [(5, 1, 5), (40, 2, 60), (7, 3, 200), (60, 4, 1)])
def test_admission_over_pieces(spark, monkeypatch, rows, seed, longest):
    """Short and very long spans, cut into pieces of a few requests."""
    monkeypatch.setattr(bookings, "PIECE_ROWS", rows)
    requests = _spans(300, seed, longest, tables=4)
    requests += [(1000 + i, 1, DAY + timedelta(hours=3 * i), DAY + timedelta(hours=3 * i - 2), i) for i in range(10)]  # backwards
    found, _ = bookings.first_come(spark.createDataFrame(requests, SPAN))
    assert {r.request_id for r in found.collect()} == _first_come(requests)


@pytest.mark.parametrize("order", ["as they start", "any"])
def test_a_long_chain_takes_few_rounds(spark, order):
    """100,000 requests of one table, each meeting the one before and the one after."""
    n = 100_000
    arrival = list(range(n))
    if order == "any":
        random.Random(5).shuffle(arrival)
    df = spark.createDataFrame(list(enumerate(arrival)), "request_id int, arrival int").selectExpr(
        "request_id", "1 as table_id", "timestamp_ntz'2026-04-20 00:00:00' + make_dt_interval(0, 0, request_id) as start_at",
        "timestamp_ntz'2026-04-20 00:00:00' + make_dt_interval(0, 0, request_id, 90) as end_at", "arrival",
    )
    found, rounds = bookings.first_come(df)
    taken, want = set(), []
    for request in sorted(range(n), key=arrival.__getitem__):
        if request - 1 not in taken and request + 1 not in taken:
            taken.add(request)
            want.append(request)
    assert rounds <= 5
    assert sorted(r.request_id for r in found.collect()) == sorted(want)


def test_requests_without_a_span_are_accepted(spark):
    rows = [(1, 1, None, DAY, 1), (2, 1, DAY, None, 2), (3, None, DAY, DAY, 3), (4, 1, DAY, DAY + timedelta(hours=1), None)]
    found, rounds = bookings.first_come(spark.createDataFrame([*rows, (5, 1, DAY, DAY + timedelta(hours=2), 0)], SPAN))
    assert {r.request_id for r in found.collect()} == {1, 2, 3, 4} and rounds == 1
    nothing, rounds = bookings.first_come(spark.createDataFrame([], SPAN))
    assert nothing.count() == 0 and rounds == 0


@pytest.mark.parametrize("limit", [50_000, 7])
def test_admitting_a_batch_equals_admitting_one_by_one(spark, many_partitions, monkeypatch, limit):
    monkeypatch.setattr(bookings, "PIECE_ROWS", limit)
    requests, held = _spans(400, 3, 5), _spans(15, 4, 3)
    open_tables = {1, 2, 3, 5}
    taken, want = list(held), set()
    for request in sorted(requests, key=lambda r: (r[4], r[0])):
        if request[1] in open_tables and not any(_meet(request, t) for t in taken):
            taken.append(request)
            want.add(request[0])
    tables = spark.createDataFrame([(i, i in open_tables) for i in range(1, 7)], "id int, is_available boolean")
    decided = bookings.admit_reservations(
        spark.createDataFrame(requests, SPAN),
        spark.createDataFrame(held, SPAN).withColumnRenamed("request_id", "id"),
        tables,
    ).collect()
    assert len(decided) == len(requests)
    assert {r.request_id for r in decided if r.accepted} == want


def _all_paths(roads, start, end):
    found, open_paths = [], [[start]]
    while open_paths:
        path = open_paths.pop()
        if path[-1] == end:
            found.append(path)
            continue
        open_paths += [path + [b] for a, b in roads if a == path[-1] and b not in path]
    return found


@pytest.mark.parametrize("seed, hops, beam", [(0, 4, 1000), (1, 1, 1), (2, 3, 2), (3, 4, 1)])
def test_routes_in_a_network_with_circles_and_dead_ends(spark, monkeypatch, seed, hops, beam):
    for name, value in {"HOPS": hops, "HOPS_BACK": min(hops, 2), "BEAM": beam}.items():
        monkeypatch.setattr(routes, name, value)
    rng = random.Random(seed)
    # every name is part of another one, which must not matter
    cities = [(i, "X" * (i + 1), *(rng.randint(0, 12) for _ in range(3))) for i in range(9)]
    roads = sorted({(rng.randrange(9), rng.randrange(9)) for _ in range(24)})
    city_df = spark.createDataFrame(cities, "id int, name string, rubies int, emeralds int, sapphires int")
    road_df = spark.createDataFrame(roads, "from_city_id int, to_city_id int")
    paths = _all_paths(roads, 0, 8)
    found = routes.enumerate_routes(city_df, road_df, 0, 8)
    assert sorted(list(r.path) for r in found.collect()) == sorted(paths)

    best, score = [], None
    for path in paths:
        left = [[max(0, cities[c][gem] - step) for step, c in enumerate(path)] for gem in (2, 3, 4)]
        for r, e, s in itertools.product(range(len(path)), repeat=3):
            mark = (left[0][r] + left[1][e] + left[2][s], -len(path))
            row = (" -> ".join(cities[c][1] for c in path), mark[0], *(cities[path[i]][1] for i in (r, e, s)))
            if score is None or mark > score:
                best, score = [], mark
            if mark == score:
                best.append(row)
    assert [tuple(r) for r in routes.best_routes(city_df, road_df, 0, 8).collect()] == sorted(
        best, key=lambda r: (r[0], *r[2:])
    )
    steps = routes.route_steps(found, city_df)
    assert steps.count() == sum(map(len, paths))


@pytest.mark.parametrize("hops", [1, 4])
def test_texts_of_routes_are_read_along_the_roads(spark, monkeypatch, hops):
    monkeypatch.setattr(routes, "HOPS", hops)
    # equal names, names within names, a name that holds the arrow, and one that starts like it
    names = ["A", "B", "B", "A -> B", "AB", "C", "B -> C", None]
    roads = [(0, 1), (0, 4), (1, 5), (2, 5), (3, 5), (4, 2), (0, 6), (1, 0), (5, 7), (4, 1)]
    city_df = spark.createDataFrame([(i, n, 1, 1, 1) for i, n in enumerate(names)],
                                    "id int, name string, rubies int, emeralds int, sapphires int")
    road_df = spark.createDataFrame(roads, "from_city_id int, to_city_id int")
    texts = ["A -> B -> C", "A -> AB -> B -> C", "B -> A -> B", "A", "AB -> C", "", " -> ", None, "A", "C -> nowhere"]
    walks = [[i] for i in range(len(names))]
    for walk in walks:
        walks += [walk + [b] for a, b in roads if a == walk[-1] and b not in walk]
    readable = [w for w in walks if all(names[c] is not None for c in w)]
    want = {(text, tuple(w)) for text in texts for w in readable if text == " -> ".join(names[c] for c in w)}
    assert {(t, w) for t, w in want if t == "A -> B -> C"} == {
        ("A -> B -> C", w) for w in [(0, 1, 5), (3, 5), (0, 6)]
    }
    found = routes.text_route_steps(spark.createDataFrame([(t,) for t in texts], "text string"), city_df, road_df)
    rows = sorted((r.text, tuple(r.path), r.step, r.city_id, r.city) for r in found.collect())
    assert rows == sorted((t, w, i, c, names[c]) for t, w in want for i, c in enumerate(w))


@pytest.mark.parametrize("heads", [10_000, 3])
def test_texts_that_share_their_beginnings_are_read_from_there(spark, monkeypatch, heads):
    """Equal names, a city that is there twice, dead ends, texts that are beginnings of others, overlapping arrows."""
    monkeypatch.setattr(routes, "SHARED", 2, raising=False)
    monkeypatch.setattr(routes, "HEADS", heads, raising=False)
    names = ["A", "B", "B", "C", "C", "D", "E", "", "-> x"]
    ids = [0, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    roads = [(0, 1), (0, 2), (1, 3), (2, 3), (2, 4), (3, 5), (4, 5), (5, 6), (6, 0), (5, 7), (0, 8), (3, 1), (4, 2)]
    city_df = spark.createDataFrame([(i, names[i], 1, 1, 1) for i in ids], "id int, name string, rubies int, emeralds int, sapphires int")
    road_df = spark.createDataFrame(roads, "from_city_id int, to_city_id int")
    walks = [[i] for i in range(len(names))]
    for walk in walks:
        walks += [walk + [b] for a, b in roads if a == walk[-1] and b not in walk]
    texts = sorted({" -> ".join(names[c] for c in w) for w in walks}) + ["A -> B -> E", "A -> B -> C -> nowhere", "Z -> A", "Z -> B", None]
    want = Counter()
    for text in texts:
        for w in walks:
            if text == " -> ".join(names[c] for c in w):
                times = 2 ** w.count(5)  # for each time a city is there
                want.update({(text, tuple(w), i, c, names[c]): times * (2 if c == 5 else 1) for i, c in enumerate(w)})
    found = routes.text_route_steps(spark.createDataFrame([(t,) for t in texts], "text string"), city_df, road_df)
    assert Counter((r.text, tuple(r.path), r.step, r.city_id, r.city) for r in found.collect()) == want


def test_rounds_of_reading_are_those_after_the_shared_beginning(spark, monkeypatch):
    monkeypatch.setattr(routes, "SHARED", 5, raising=False)
    rounds, observed = [], routes.observed
    monkeypatch.setattr(routes, "observed", lambda df, **x: rounds.append(set(df.columns)) or observed(df, **x))
    city_df = spark.createDataFrame([(i, f"c{i}", 1, 1, 1) for i in range(30)], "id int, name string, rubies int, emeralds int, sapphires int")
    chain = list(range(10))
    road_df = spark.createDataFrame([(i, i + 1) for i in chain[:-1]] + [(9, c) for c in range(10, 30)], "from_city_id int, to_city_id int")
    texts = [" -> ".join(f"c{c}" for c in [*chain, last]) for last in range(10, 30)]
    found = routes.text_route_steps(spark.createDataFrame([(t,) for t in texts], "text string"), city_df, road_df)
    assert {(r.text, tuple(r.path)) for r in found.collect()} == {(t, (*chain, 10 + i)) for i, t in enumerate(texts)}
    assert sum({"text", "path"} <= x for x in rounds) == 2  # where the beginning ends, and the name after it


def test_every_route_is_among_the_readings_of_its_text(spark):
    rng = random.Random(5)
    cities = [(i, "XY"[i % 2] * (1 + i // 4), 1, 1, 1) for i in range(9)]
    roads = sorted({(rng.randrange(9), rng.randrange(9)) for _ in range(24)})
    city_df = spark.createDataFrame(cities, "id int, name string, rubies int, emeralds int, sapphires int")
    road_df = spark.createDataFrame(roads, "from_city_id int, to_city_id int")
    found = routes.enumerate_routes(city_df, road_df, 0, 8)
    texts = routes.route_texts(found, city_df).collect()
    read = routes.text_route_steps(spark.createDataFrame([(r.text,) for r in texts], "text string"), city_df, road_df)
    pairs = {(r.text, tuple(r.path)) for r in read.select("text", "path").distinct().collect()}
    assert texts and {(r.text, tuple(r.path)) for r in texts} <= pairs


def test_bounds_cut_at_least_half_of_the_open_routes(spark):
    v = Venue(spark, "/root/testdata/sf0.01")
    seen = {"all": [], "best": []}
    routes.enumerate_routes(v.cities, v.roads, "depot", "gate", lambda hop, n: seen["all"].append((hop, n["open"])))
    routes.best_routes(v.cities, v.roads, "depot", "gate", lambda hop, n: seen["best"].append((hop, n["open"])))
    everything, cut = (sum(n for _, n in seen[x]) for x in ("all", "best"))
    assert seen["all"][-1][1] == 0 and 2 * cut <= everything


def test_a_route_that_is_already_there(spark):
    cities = spark.createDataFrame([(1, "a", 1, 2, 3)], "id int, name string, rubies int, emeralds int, sapphires int")
    roads = spark.createDataFrame([(1, 1)], "from_city_id int, to_city_id int")
    assert [tuple(r) for r in routes.best_routes(cities, roads, 1, 1).collect()] == [("a", 6, "a", "a", "a")]


def test_crowded_keys_meet_as_in_a_plain_join(spark, monkeypatch):
    monkeypatch.setattr(crowded, "CROWD", 5)
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 9 + [2] * 6 + [3, 3, 4] + [None] * 8)], "k int, i int")
    side = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (3, "d"), (None, "e"), (5, "f")], "k int, v string")
    assert sorted(crowded.met(rows, side, ["k"]).collect()) == sorted(rows.join(side, ["k"]).collect())


def test_routes_through_one_city_do_not_share_a_task(spark, monkeypatch):
    """All routes leave 0 and pass 1 and 2; 3 is in a text twice, 4 has no name."""
    monkeypatch.setattr(crowded, "CROWD", 20)
    middle = range(10, 40)
    cities = [(c, None if c == 4 else f"c{c}", c, 2, 3) for c in [0, 1, 2, 3, 3, 4, *middle]]
    roads = [(0, c) for c in middle] + [(c, 1) for c in middle] + [(1, 3), (1, 4), (3, 2), (4, 2)]
    city_df = spark.createDataFrame(cities, "id int, name string, rubies int, emeralds int, sapphires int")
    road_df = spark.createDataFrame(roads, "from_city_id int, to_city_id int")
    found = routes.enumerate_routes(city_df, road_df, 0, 2)
    paths = {(0, c, 1, by, 2) for c in middle for by in (3, 4)}
    assert sorted(tuple(r.path) for r in found.collect()) == sorted(paths)
    texts = routes.route_texts(found, city_df)
    want = {p: " -> ".join(f"c{c}" for c in p for _ in range(2 if c == 3 else 1) if c != 4) for p in paths}
    assert sorted((tuple(r.path), r.text) for r in texts.collect()) == sorted(want.items())

    single = city_df.dropDuplicates(["id"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        steps = routes.route_steps(found, single)
        rows = [(tuple(r.path), r.step, r.city_id, r.city) for r in steps.collect()]
        names = {c[0]: c[1] for c in cities}
        assert len(rows) == len(set(rows)) and set(rows) == {(p, i, c, names[c]) for p in paths for i, c in enumerate(p)}
        # steps in 0, 1 and 2 stay where they are
        assert "BroadcastHashJoin" in steps._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    read = routes.text_route_steps(texts.filter(~F.array_contains("path", 3)).select("text"), single, road_df)
    assert read.count() == 0  # the road to 2 leads over a city that is not in the text
    texts = routes.route_texts(found, single).filter(F.array_contains("path", 3))
    read = routes.text_route_steps(texts.select("text"), single, road_df)
    assert {tuple(r.path) for r in read.collect()} == {p for p in paths if 3 in p} and read.count() == 150
