"""A service that is asked in batches, with a ledger of what it answered."""

import uuid

import pandas as pd
import pytest

from idweave import versions as v
from idweave.operators import ServiceFailed, lookup_with_ledger, lookup_with_service
from idweave.operators.symbols import valid_requests
from idweave.session import scratch_path

SCHEMA = "DATA_ID bigint, prefix string, resolved string, weight double"


@pytest.fixture
def name(spark):
    n = f"idweave_ledger_{uuid.uuid4().hex}"
    yield n
    v.drop_versions(spark, n)


@pytest.fixture
def requests(spark):
    rows = [(i, "SED" if i % 3 else "BTKR", f"S{i}" if i % 11 else "") for i in range(1, 61)] + [(61, "SED", None)]
    return spark.createDataFrame(rows, "DATA_ID bigint, prefix string, SYMBOL_NAME string")


def service(log, broken=()):
    """Answers nothing, once or twice by id; notes what it was asked in a folder that all tasks see."""
    def ask(pdf):
        ids = [int(i) for i in pdf["DATA_ID"]]
        with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
            f.write(",".join(map(str, ids)))
        if set(ids) & set(broken):
            raise ConnectionError(f"away at {ids[0]}")
        rows = [(i, p, f"R{s}-{n}", None if i % 2 else float(i)) for i, p, s in zip(ids, pdf["prefix"], pdf["SYMBOL_NAME"])
                for n in range(i % 3)]
        return pd.DataFrame(rows, columns=["DATA_ID", "prefix", "resolved", "weight"])

    return ask


def asked(log):
    return sorted(int(i) for f in log.iterdir() for i in f.read_text().split(","))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def ids(df):
    return sorted(r.DATA_ID for r in valid_requests(df).collect())


@pytest.mark.parametrize("wave", [1, 3, 1000])
def test_a_broken_run_goes_on_where_it_stopped(spark, requests, name, tmp_path, wave):
    logs = [tmp_path / str(k) for k in range(4)]
    for log in logs:
        log.mkdir()
    clean = rows(lookup_with_service(requests, service(logs[3]), SCHEMA, 4))
    with pytest.raises(ServiceFailed, match="2 batches .*ConnectionError: away"):
        lookup_with_ledger(requests, service(logs[0], broken=(7, 30)), SCHEMA, 4, name, wave=wave)
    assert asked(logs[0]) == ids(requests)
    ledger = spark.table(name)
    answered = {r.DATA_ID for r in ledger.where("kind = 'request'").collect()}
    assert 0 < len(ids(requests)) - len(answered) <= 8 and not answered & {7, 30}
    got = lookup_with_ledger(requests, service(logs[1]), SCHEMA, 4, name, wave=wave)
    assert rows(got) == clean and len(clean) > 30
    assert set(asked(logs[1])) == set(ids(requests)) - answered  # nothing twice
    assert rows(lookup_with_ledger(requests, service(logs[2]), SCHEMA, 4, name)) == clean
    assert asked(logs[2]) == []


def test_only_new_requests_are_asked_and_only_theirs_are_returned(spark, requests, name, tmp_path):
    lookup_with_ledger(requests.where("DATA_ID <= 20"), service(tmp_path), SCHEMA, 6, name)
    log = tmp_path / "second"
    log.mkdir()
    part = requests.where("DATA_ID BETWEEN 10 AND 40")
    got = lookup_with_ledger(part, service(log), SCHEMA, 6, name)
    assert asked(log) == [i for i in ids(part) if i > 20]
    other = tmp_path / "plain"
    other.mkdir()
    assert rows(got) == rows(lookup_with_service(part, service(other), SCHEMA, 6))


def test_a_service_that_is_down_is_not_asked_for_ever(requests, name, tmp_path):
    with pytest.raises(ServiceFailed, match="batches were not answered"):
        lookup_with_ledger(requests, service(tmp_path, broken=range(100)), SCHEMA, 1, name, wave=2, max_failures=3)
    assert len(asked(tmp_path)) <= 6


def test_no_requests(spark, requests, name, tmp_path):
    got = lookup_with_ledger(requests.where("false"), service(tmp_path), SCHEMA, 4, name)
    assert got.count() == 0 and got.columns == ["DATA_ID", "prefix", "resolved", "weight"]
    assert scratch_path(spark, "x")
