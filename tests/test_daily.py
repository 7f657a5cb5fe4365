"""The daily run equals a full run over the new inputs."""

import datetime as dt
import random
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from idweave import versions as v
from idweave.plans import DuplicateKeys, Sources, identifiers_historic, publish_daily, publish_state, source_changes
from idweave.plans.daily import ENRICHED
from idweave.session import materialize

D = dt.date
DAYS = [D(2024, 1, 1) + dt.timedelta(days=3 * k) for k in range(12)]
SECS = [str(k) for k in range(1, 7)]


def fresh():
    return f"idweave_daily_{uuid.uuid4().hex}"


def random_inputs(rng):
    """The rows of the six inputs, as lists."""
    alloc = [(k, 1, rng.randint(1, 3), float(k), int(rng.choice(SECS)), rng.choice(["ADR", "COM", "BND"]),
              rng.choice(["ACCT", "ACCT", "CNCL"]), d, d - dt.timedelta(days=rng.randint(0, 1)))
             for k in range(1, 41) for d in [rng.choice(DAYS)]]
    dates = [(d,) for d in rng.sample(DAYS, 4)]
    secs = [(d, s, f"E{s}", rng.choice([None, "", f"S{s}"]), "c", "i", rng.choice(["THB", "AUD", "USD"]),
             rng.choice([f"T{s}ZZ", f"T{s}"])) for (d,) in dates for s in SECS if rng.random() < 0.9]

    def ref():
        return [(s, int((d + dt.timedelta(days=1)).strftime("%Y%m%d")), f"P{s}", rng.choice([None, "x", "y"]), "t", "i")
                for s in SECS for d in DAYS if rng.random() < 0.4]

    symbols = [("SED", f"S{s}") for s in SECS] + [("BTKR", f"T{s} {e}") for s in SECS for e in ("TB", "AU")]
    sym = [(p, s, a, a + dt.timedelta(days=rng.randint(0, 30)), f"{p}{s}{n}") for p, s in symbols
           for n in range(rng.randint(0, 2)) for a in [rng.choice(DAYS)]]
    return [alloc, dates, secs, ref(), ref(), sym]


def altered(rng, rows, other):
    """Some inputs with rows gone, come or changed."""
    out = []
    for mine, theirs in zip(rows, other):
        if rng.random() < 0.6:
            keep = [r for r in mine if rng.random() < 0.85]
            mine = keep
            if len(mine) and len(mine[0]) in (6, 5) and rng.random() < 0.5:
                mine = [(*r[:-1], r[-1] + "+") if rng.random() < 0.2 else r for r in mine]
            mine = mine + [r for r in theirs if rng.random() < 0.15 and _key(r) not in {_key(x) for x in mine}]
        out.append(mine)
    return out


def _key(r):
    return r[:2] if len(r) in (6, 8) else r[:1] if len(r) == 9 else r


def as_sources(spark, src, rows):
    frames = [spark.createDataFrame(r, getattr(src, n).schema) for r, n in zip(rows, Sources.__dataclass_fields__)]
    return Sources(*(materialize(f, "daily-input") for f in frames))


def without_ids(df):
    cols = sorted(c for c in df.columns if c not in ("DATA_ID", "process_type"))
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_daily_runs_equal_full_runs(spark, src, seed):
    rng, name = random.Random(seed), fresh()
    rows = random_inputs(rng)
    now = as_sources(spark, src, rows)
    publish_state(now, name)
    assert without_ids(spark.table(name)) == without_ids(identifiers_historic(now))
    ids = {}
    for _ in range(2):
        rows = altered(rng, rows, random_inputs(rng))
        then, now = now, as_sources(spark, src, rows)
        counts = publish_daily(now, source_changes(then, now), name)
        want = identifiers_historic(now)
        assert without_ids(spark.table(name)) == without_ids(want)
        assert counts["result"] == spark.table(name).count()
        registry = {(r.sec_id, r.trade_date_est, r.trade_date_local): r.DATA_ID for r in spark.table(f"{name}_ids").collect()}
        assert registry.items() >= ids.items() and len(set(registry.values())) == len(registry)
        ids = registry
        for r in v.companion(spark, name, ENRICHED).collect():
            assert ids[r.sec_id, r.trade_date_est, r.trade_date_local] == r.DATA_ID
    for n in (name, f"{name}_ids"):
        v.drop_versions(spark, n)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name)]


def test_nothing_changed_touches_nothing_and_one_row_touches_its_own(spark, src, expected):
    name = fresh()
    counts = publish_state(src, name)
    assert counts["result"] == expected["result"] and counts["enriched"] == expected["enriched"]
    none = Sources(*(getattr(src, n).where("false") for n in Sources.__dataclass_fields__))
    again = publish_daily(src, none, name)
    assert again == {**counts, "touched": 0}
    row = spark.table(name).where("equity_file_eff_dt IS NOT NULL").first()
    hit = (F.col("sec_id") == str(row.sec_id)) & (F.col("file_eff_dt") == row.equity_file_eff_dt)
    now = replace(src, ref_equity=src.ref_equity.withColumn("ticker", F.when(hit, "changed").otherwise(F.col("ticker"))))
    more = publish_daily(now, replace(none, ref_equity=src.ref_equity.where(hit)), name)
    assert 0 < more["touched"] < 5 and more["result"] == counts["result"]
    got = spark.table(name).where("underlying_ticker = 'changed'").select("DATA_ID").distinct().collect()
    assert 0 < len(got) <= more["touched"]
    for n in (name, f"{name}_ids"):
        v.drop_versions(spark, n)


def test_a_duplicate_key_leaves_the_last_version(spark, src):
    rng, name = random.Random(9), fresh()
    rows = random_inputs(rng)
    now = as_sources(spark, src, rows)
    publish_state(now, name)
    before = v.current_version(spark, name)
    twice = as_sources(spark, src, [*rows[:3], rows[3] + [(*r[:-1], "again") for r in rows[3]], *rows[4:]])
    with pytest.raises(DuplicateKeys):
        publish_daily(twice, source_changes(now, twice), name)
    assert v.current_version(spark, name) == before and v.unlisted_parts(spark, name) == []
    for n in (name, f"{name}_ids"):
        v.drop_versions(spark, n)
