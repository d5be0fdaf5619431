"""Set-based rules against row-by-row simulations on random, skewed input.

``hot_rows`` is tiny here, so that most keys take the salted or blocked path.
"""

import random

import pytest
from pyspark.sql import functions as F

from deedflow.operators import effects, gates
from deedflow.operators.ordering import with_ids, with_previous
from deedflow.operators.skew import heavy_keys, spread_join

SEEDS = [1, 2, 3]
HOT = [2, 200_000]


def skewed(rng, n, low=1):
    """Keys of which a third are one value and some are NULL."""
    return [rng.choices([1, None, rng.randint(low, 30)], [3, 1, 5])[0] for _ in range(n)]


def collect(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


@pytest.mark.parametrize("hot_rows", HOT)
@pytest.mark.parametrize("seed", SEEDS)
def test_spread_join(spark, seed, hot_rows):
    rng = random.Random(seed)
    keys = skewed(rng, 400)
    pairs = [(i, k, rng.choice(["a", "b", None])) for i, k in enumerate(keys)]
    rows = spark.createDataFrame(pairs, "seq long, k int, l string")
    held = {(k, l): f"{k}{l}" for k in range(1, 31, 2) for l in "ab"}
    state = spark.createDataFrame([(*k, v) for k, v in held.items()], "k int, l string, v string")
    joined = spread_join(rows, state, ["k", "l"], "seq", hot_rows=hot_rows)
    found = {r.seq: r.v for r in joined.collect()}
    assert joined.count() == len(pairs)
    assert found == {i: held.get((k, l)) for i, k, l in pairs}
    fans = {r.k: r._fan for r in heavy_keys(rows, ["k"], hot_rows).collect()}
    wanted = {k: -(-keys.count(k) // hot_rows) for k in set(keys) if keys.count(k) > hot_rows}
    assert fans == wanted and (None in fans) == (hot_rows == 2)


@pytest.mark.parametrize("hot_rows", HOT)
@pytest.mark.parametrize("seed", SEEDS)
def test_with_previous(spark, seed, hot_rows):
    rng = random.Random(seed)
    seqs = rng.sample(range(2000), 400)
    rows = [(s, k, rng.choice("xyz")) for s, k in zip(seqs, skewed(rng, 400))]
    frame = spark.createDataFrame(rows, "seq long, k int, v string")
    found = {r.seq: r.p for r in with_previous(frame, "k", "seq", "v", "p", hot_rows).collect()}
    last, wanted = {}, {}
    for seq, key, value in sorted(rows):
        wanted[seq] = None if key is None else last.get(key)
        last[key] = value
    assert found == wanted


@pytest.mark.parametrize(
    "numbers",
    [
        range(1000),
        random.Random(1).sample(range(10**6), 500),
        random.Random(2).sample(range(-(2**61), 2**61), 500),
        [n << 16 for n in range(300)] + [n << 33 for n in range(1, 300)],
        [],
    ],
)
def test_with_ids(spark, numbers):
    numbers = list(numbers)
    frame = spark.createDataFrame([(n,) for n in numbers], "seq long")
    found = collect(with_ids(frame, "seq", "id", 7), "seq", "id")
    assert found == [(n, 8 + i) for i, n in enumerate(sorted(numbers))]


def properties(spark, rng, keys):
    rows = [
        (k, rng.choice(["House", "House", "Villa"]), rng.choice(["Sold", "For Sale", "On Hold"]))
        for k in keys
    ]
    return rows, spark.createDataFrame(rows, "property_ID int, property_TYPE string, prop_status string")


@pytest.mark.parametrize("hot_rows", HOT)
@pytest.mark.parametrize("seed", SEEDS)
def test_sold_gate(spark, seed, hot_rows):
    rng = random.Random(seed)
    held, frame = properties(spark, rng, range(1, 25))
    status = {k: s for k, _, s in held}
    batch = [(i, k, rng.random() < 0.7) for i, k in enumerate(skewed(rng, 300))]
    rows = spark.createDataFrame(batch, "seq long, property_ID int, storable boolean")
    judged = gates.sold_gate(rows, frame, storable="storable", hot_rows=hot_rows)
    wanted = []
    for seq, key, storable in batch:
        rejected = status.get(key) == "Sold"
        wanted.append((seq, rejected))
        if storable and not rejected and key in status:
            status[key] = "Sold"
    assert collect(judged, "seq", F.col("reject").isNotNull()) == wanted


@pytest.mark.parametrize("hot_rows", HOT)
@pytest.mark.parametrize("seed", SEEDS)
def test_sold_gate_with_contracts(spark, seed, hot_rows):
    rng = random.Random(seed)
    held, frame = properties(spark, rng, range(1, 25))
    kind = {k: t for k, t, _ in held}
    status = {k: s for k, _, s in held}
    seqs = rng.sample(range(5000), 400)
    events = [(s, k, rng.random() < 0.6) for s, k in zip(seqs, skewed(rng, 400))]
    rows = spark.createDataFrame(events, "seq long, property_ID int, sale boolean")
    sales, contracts = rows.filter("sale"), rows.filter("NOT sale")
    judged = gates.sold_gate_with_contracts(sales, contracts, frame, hot_rows=hot_rows)
    after = effects.final_status(frame, sales, contracts)
    wanted = []
    for seq, key, sale in sorted(events):
        if sale:
            rejected = status.get(key) == "Sold"
            wanted.append((seq, rejected))
            if key in status:
                status[key] = "Sold"
        elif kind.get(key) == "House":
            status[key] = "For Sale"
    assert collect(judged, "seq", F.col("reject").isNotNull()) == wanted
    assert dict(collect(after, "property_ID", "prop_status")) == status


@pytest.mark.parametrize("hot_rows", HOT)
@pytest.mark.parametrize("seed", [*SEEDS, 4, 5])
def test_exclusivity_gate(spark, seed, hot_rows):
    rng = random.Random(seed)
    values = rng.choice([[None, "Yes", "No"], ["No", "No", None, "No", "Yes"]])
    schema = "seq long, date_contract int, exclusivity string, storable boolean"
    stored = [(i, rng.randint(1, 10), rng.choice(["No", "No", "Yes"]), True) for i in range(8)]
    batch = [
        (i, k, rng.choice(values), rng.random() < 0.8) for i, k in enumerate(skewed(rng, 250))
    ]
    judged = gates.exclusivity_gate(
        spark.createDataFrame(batch, schema),
        spark.createDataFrame(stored, schema),
        storable="storable",
        hot_rows=hot_rows,
    )
    held, wanted = [(k, v) for _, k, v, _ in stored], []
    for seq, key, value, storable in batch:
        yes = key is not None and (key, "Yes") in held
        no = key is not None and (key, "No") in held
        rejected = yes or (no and value == "Yes")
        wanted.append((seq, rejected))
        if storable and not rejected:
            held.append((key, value))
    # A contract without a date is not storable, so no row can clash with it.
    found = collect(judged, "seq", F.col("reject").isNotNull())
    dated = {i for i, k, _, _ in batch if k is not None}
    assert [f for f in found if f[0] in dated] == [w for w in wanted if w[0] in dated]


@pytest.mark.parametrize("hot_rows", HOT)
def test_date_gates(spark, hot_rows):
    rng = random.Random(9)
    batch = [(i, k, rng.randint(1, 9)) for i, k in enumerate(skewed(rng, 300))]
    others = [(k, rng.randint(1, 9)) for k in skewed(rng, 25, low=2)]
    rows = spark.createDataFrame(batch, "seq long, property_ID int, day int")
    state = spark.createDataFrame(others, "property_ID int, day int")
    days = {}
    for key, day in others:
        days.setdefault(key, []).append(day)
    days.pop(None, None)
    options = {"day": "day", "hot_rows": hot_rows}
    found = gates.appointment_gate(rows, state, contract_day="day", **options)
    wanted = [(s, k in days and d <= min(days[k])) for s, k, d in batch]
    assert collect(found, "seq", F.col("reject").isNotNull()) == wanted
    found = {r.seq: r.reject for r in gates.review_gate(rows, state, sale_day="day", **options).collect()}
    for seq, key, day in batch:
        held = days.get(key, [])
        late = "review_before_sale" if held and day <= held[0] else None
        assert found[seq] == ("ambiguous_sale" if len(held) > 1 else late)
