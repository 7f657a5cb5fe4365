"""Symbol requests, batching and lookup over a dated symbol table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import PREFIX_SEDOL, PREFIX_TICKER, TICKER_RULES
from ..functions.dates import day_end, day_start
from ..functions.tickers import local_ticker
from ..session import materialize
from ..versions import append_version, current_version
from .ids import assign_ids
from .skew import salted_join

REQUEST_COLUMNS = ("DATA_ID", "prefix", "sec_id", "currency", "ticker", "sedol",
                   "order_start_date", "order_end_date", "sym_date",
                   "SYMBOL_NAME", "SYMBOL_NAME_BASE", "process_type")
BUCKET_MONTHS = {"month": 1, "quarter": 3, "year": 12}
RESPONSE_COLUMNS = ("DATA_ID", "prefix", "SYMBOL_NAME", "resolved", "valid_from", "valid_to")


def valid_requests(df: DataFrame, col: str = "SYMBOL_NAME") -> DataFrame:
    """Drop requests whose symbol is NULL or empty: they can never match."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != F.lit("")))


def _request(df: DataFrame, prefix: str, symbol, base, date_col: str,
             carry: Sequence[str], process_type: str) -> DataFrame:
    d = F.col(date_col)
    return df.select(
        F.col("DATA_ID"),
        F.lit(prefix).alias("prefix"),
        F.col("sec_id"),
        F.col("sec_currency").alias("currency"),
        F.col("ticker"),
        F.col("sedol"),
        day_start(d).alias("order_start_date"),
        day_end(d).alias("order_end_date"),
        d.cast("date").alias("sym_date"),
        symbol.alias("SYMBOL_NAME"),
        base.alias("SYMBOL_NAME_BASE"),
        F.lit(process_type).alias("process_type"),
        *carry,
    )


def sedol_requests(df: DataFrame, date_col: str = "trade_date_local",
                   carry: Sequence[str] = (), valid_only: bool = True,
                   process_type: str = "historic") -> DataFrame:
    """One SEDOL request per enriched row: the symbol is the snapshot SEDOL."""
    out = _request(df, PREFIX_SEDOL, F.col("sedol"), F.lit(None).cast("string"), date_col, carry,
                   process_type)
    return valid_requests(out) if valid_only else out


def ticker_requests(df: DataFrame, rules: dict = TICKER_RULES, mode: str = "always",
                    date_col: str = "trade_date_local", carry: Sequence[str] = (),
                    valid_only: bool = True, process_type: str = "historic") -> DataFrame:
    """Local-ticker requests for the currencies in ``rules`` (NULL currency is dropped)."""
    src = df.filter(F.col("sec_currency").isin(list(rules)))
    symbol, base = local_ticker(F.col("ticker"), F.col("sec_currency"), rules, mode)
    out = _request(src, PREFIX_TICKER, symbol, base, date_col, carry, process_type)
    return valid_requests(out) if valid_only else out


def symbol_requests(df: DataFrame, rules: dict = TICKER_RULES, ticker_mode: str = "always",
                    date_col: str = "trade_date_local", keep_input: bool = False,
                    process_type: str = "historic") -> DataFrame:
    """SEDOL and local-ticker requests of every row in one pass.

    Each row yields up to two requests (an ``explode`` of a two-element array,
    then invalid symbols are dropped), so the input is read once. With
    ``keep_input`` every input column rides along, which lets the lookup return
    whole result rows without joining back by ``DATA_ID``.
    """
    symbol, base = local_ticker(F.col("ticker"), F.col("sec_currency"), rules, ticker_mode)
    sed = F.struct(F.lit(PREFIX_SEDOL).alias("prefix"), F.col("sedol").alias("SYMBOL_NAME"),
                   F.lit(None).cast("string").alias("SYMBOL_NAME_BASE"))
    tick = F.when(F.col("sec_currency").isin(list(rules)),
                  F.struct(F.lit(PREFIX_TICKER).alias("prefix"), symbol.alias("SYMBOL_NAME"),
                           base.alias("SYMBOL_NAME_BASE")))
    d = F.col(date_col)
    # Generate + Filter, both inside whole-stage codegen.
    exploded = (df.withColumn("_r", F.explode(F.array(sed, tick)))
                .filter(F.col("_r").isNotNull() & F.col("_r.SYMBOL_NAME").isNotNull()
                        & (F.col("_r.SYMBOL_NAME") != F.lit(""))))
    req = {
        "prefix": F.col("_r.prefix"),
        "order_start_date": day_start(d),
        "order_end_date": day_end(d),
        "sym_date": d.cast("date"),
        "SYMBOL_NAME": F.col("_r.SYMBOL_NAME"),
        "SYMBOL_NAME_BASE": F.col("_r.SYMBOL_NAME_BASE"),
    }
    if keep_input:
        return exploded.withColumns(req).drop("_r")
    return exploded.select(
        "DATA_ID", req["prefix"].alias("prefix"), "sec_id",
        F.col("sec_currency").alias("currency"), "ticker", "sedol",
        *[v.alias(k) for k, v in req.items() if k != "prefix"],
        F.lit(process_type).alias("process_type"))


def batch_requests(df: DataFrame, size: int, id_col: str = "DATA_ID") -> DataFrame:
    """Add ``batch_no``: per prefix, the requests in id order in batches of ``size``.

    Every request is in one batch, and no batch holds two prefixes or more than
    ``size`` requests. The requests are numbered once in the order (prefix, id)
    and written (``assign_ids``); a prefix starts at its smallest number, broadcast, since
    a shuffle on the prefix would send all its requests to one task. The
    input is evaluated once.
    """
    if size < 1:
        raise ValueError("batch size must be positive")
    numbered = assign_ids(df, ["prefix", id_col], "_row")
    first = numbered.groupBy("prefix").agg(F.min("_row").alias("_first"))  # one row per prefix
    return (numbered.join(F.broadcast(first), numbered["prefix"].eqNullSafe(first["prefix"])).drop(first["prefix"])
            .withColumn("batch_no", F.floor((F.col("_row") - F.col("_first")) / F.lit(size)).cast("bigint"))
            .drop("_row", "_first"))


def lookup_symbols(requests: DataFrame, symbology: DataFrame, carry: Sequence[str] = (),
                   skew: str = "aqe", bucket: str | None = None, date_col: str = "sym_date") -> DataFrame:
    """Resolve requests against a dated symbol table.

    Equi-join on (prefix, symbol) with the trade date inside
    [valid_from, valid_to] as a residual condition. Name the requests' own trade date as ``date_col`` if it is carried
    anyway: ``sym_date`` is then not shuffled beside it. NULL and empty symbols are
    dropped first: they never match and would all hash to one task. A hot
    symbol is split by AQE's skew join, or with ``skew="salt"`` by salting
    (``salted_join``) when AQE is off.

    ``bucket="month"`` (or ``"quarter"``, ``"year"``) puts the calendar bucket of the
    date into the key, and each validity range is copied to the buckets it spans. Use it
    for a table with many validity rows per symbol: a request then meets the
    rows of its bucket, not all rows of its symbol. Only copies for buckets that the symbol's
    requests may ask for are made and shuffled (``_asked_copies``), for which the requests are stored once.
    """
    req = valid_requests(requests)
    sym = symbology.select(F.col("prefix").alias("_p"), F.col("symbol").alias("_s"),
                           "valid_from", "valid_to", "resolved")
    left, right = ["prefix", "SYMBOL_NAME"], ["_p", "_s"]
    if bucket is not None:
        wanted = [c for c in dict.fromkeys(("DATA_ID", "prefix", "SYMBOL_NAME", "sym_date", *carry))
                  if c in req.columns]
        req = materialize(req.select(*wanted), "asked").withColumn("_rb", F.trunc("sym_date", bucket))
        sym = _asked_copies(req, sym, bucket)
        left, right = [*left, "_rb"], [*right, "_sb"]
    day = req["sym_date" if bucket is not None else date_col].cast("date")
    in_range = day.between(sym["valid_from"], sym["valid_to"])
    if skew == "salt":
        joined = salted_join(req, sym, left, right, "inner", condition=in_range)
    elif skew == "aqe":
        cond = in_range
        for r, s in zip(left, right):
            cond = cond & (req[r] == sym[s])
        joined = req.join(sym, cond, "inner")
    else:
        raise ValueError(f"unknown skew mode {skew!r}")
    return joined.select(*RESPONSE_COLUMNS, *carry)


def _asked_copies(req: DataFrame, sym: DataFrame, bucket: str) -> DataFrame:
    """The rows of ``sym`` copied to the buckets they span (``_sb``), without those that no request can meet.

    Each symbol's buckets are marked in the 64 bits of one number, by bucket number modulo 64, a sum of fixed
    width. The numbers meet the rows of ``sym`` before these are copied, by a hash join on the symbol, and a copy
    whose bit is not set goes no further. A bit may stand for several buckets: the join
    on the bucket itself decides.
    """
    def bit(day: str):
        number = f"(year({day}) * 12 + month({day}) - 1) div {BUCKET_MONTHS[bucket]}"
        return F.expr(f"shiftleft(1L, CAST(pmod({number}, 64) AS INT))")

    marks = (req.select(F.col("prefix").alias("_mp"), F.col("SYMBOL_NAME").alias("_ms"), bit("_rb").alias("_mark"))
             .groupBy("_mp", "_ms").agg(F.bit_or("_mark").alias("_marks")))
    copied = (sym.where("valid_from <= valid_to")
              .join(marks.hint("shuffle_hash"), (F.col("_p") == F.col("_mp")) & (F.col("_s") == F.col("_ms")))
              .withColumn("_sb", F.explode(F.sequence(F.trunc("valid_from", bucket), F.trunc("valid_to", bucket),
                                                      F.expr(f"INTERVAL {BUCKET_MONTHS[bucket]} MONTH")))))
    return copied.where(F.col("_marks").bitwiseAND(bit("_sb")) != 0).drop("_mp", "_ms", "_marks")


def lookup_with_service(requests: DataFrame, service: Callable, schema: str,
                        batch_size: int) -> DataFrame:
    """Resolve requests through an external service, one call per batch.

    Batches come from ``batch_requests``; each batch of a prefix is one group of
    ``applyInPandas`` (at most ``batch_size`` rows, so no group is unbounded)
    and the groups are spread over the executors. ``service`` maps a pandas
    frame of requests to a pandas frame matching ``schema``. Nothing passes
    through the driver.
    """
    batched = batch_requests(valid_requests(requests), batch_size)

    def call(pdf):
        return service(pdf.drop(columns=["batch_no"]).sort_values("DATA_ID"))

    return batched.groupBy("prefix", "batch_no").applyInPandas(call, schema)


class ServiceFailed(RuntimeError):
    """Batches that the service did not answer; all others are in the ledger."""


REQUEST_KEY = ("DATA_ID", "prefix", "SYMBOL_NAME")


def lookup_with_ledger(requests: DataFrame, service: Callable, schema: str, batch_size: int, ledger: str,
                       wave: int = 1000, max_failures: int = 100) -> DataFrame:
    """``lookup_with_service`` that goes on where an earlier run stopped.

    ``ledger`` is a versioned table (``versions.append_version``) of the requests that were answered, by their key
    (``DATA_ID``, prefix, symbol), and of the answers. Requests that it holds are not asked again, whatever batch
    they would fall into; a request without an answer row counts as answered all the same. The
    others are asked in batches as in ``lookup_with_service``, ``wave`` batches of each prefix to a job, which reads only
    the files of its own batches; when a job
    ends, its answered batches become a version of the ledger in one step, requests and answers together. A batch on which
    the service raises loses its own answers only: the job commits all others, and ``ServiceFailed`` is
    raised at the end, or as soon as ``max_failures`` batches have failed. What an executor
    was asking when it died is asked again.

    Returns the answers of ``requests`` from the ledger, earlier ones included, with the columns of ``schema``; that must
    name ``DATA_ID``, which the answers carry.
    """
    spark = requests.sparkSession
    fields = T.StructType.fromDDL(schema)
    valid = materialize(valid_requests(requests), "to-ask")

    def entries(kind: str) -> DataFrame | None:
        return (spark.table(ledger).where(F.col("kind") == kind) if current_version(spark, ledger) else None)

    answered = entries("request")
    todo = valid if answered is None else valid.join(answered.select(*REQUEST_KEY), list(REQUEST_KEY), "left_anti")
    todo = materialize(batch_requests(todo, batch_size).withColumn("_wave", F.floor(F.col("batch_no") / F.lit(wave))),
                       "waves", partition_by=("_wave",))
    last = todo.agg(F.max("_wave")).first()[0]
    plain = "kind string, prefix string, DATA_ID bigint, SYMBOL_NAME string, batch_no bigint, error string"
    names = [f"answer_{i}" for i in range(len(fields))]
    entry = T.StructType([*T.StructType.fromDDL(plain), *(T.StructField(n, f.dataType) for n, f in zip(names, fields))])
    answer = F.when(F.col("kind") == "answer", F.struct(*(F.col(n).alias(f.name) for n, f in zip(names, fields))))

    def call(pdf):
        batch, prefix = int(pdf["batch_no"].iloc[0]), pdf["prefix"].iloc[0]
        asked = pdf.drop(columns=["batch_no"]).sort_values("DATA_ID")
        try:
            answers = service(asked)
        except Exception as e:  # this batch fails, the others of the job are kept
            row = {"kind": "failed", "prefix": prefix, "batch_no": batch, "error": f"{type(e).__name__}: {e}"}
            return pd.DataFrame([[row.get(c) for c in entry.names]], columns=entry.names, dtype=object)
        values = answers[fields.names].astype(object).where(answers[fields.names].notna(), None)
        n, more = len(asked), len(values)
        rows = {"kind": ["request"] * n + ["answer"] * more, "prefix": [prefix] * (n + more),
                "DATA_ID": [int(i) for i in asked["DATA_ID"]] + [int(i) for i in values["DATA_ID"]],
                "SYMBOL_NAME": list(asked["SYMBOL_NAME"]) + [None] * more, "batch_no": [batch] * (n + more),
                "error": [None] * (n + more)}
        rows |= {c: [None] * n + list(values[f]) for c, f in zip(names, fields.names)}
        return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in rows.items()})

    def ask(frames):
        rest = None
        for pdf in frames:
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            begins = rest.groupby(["prefix", "batch_no"], dropna=False, sort=False).ngroup().diff().ne(0)
            begins = begins.to_numpy().nonzero()[0].tolist()
            done = [call(rest.iloc[a:z]) for a, z in zip(begins, begins[1:])]
            if done:
                yield pd.concat(done, ignore_index=True)
                rest = rest.iloc[begins[-1]:]  # its batch may go on in the next frame
        if rest is not None and len(rest):
            yield call(rest)

    failed = []
    for no in range((-1 if last is None else last) + 1):
        asked, seen = todo.where(F.col("_wave") == no).drop("_wave"), Observation("ledger_wave")
        whole = asked.repartition("prefix", "batch_no").sortWithinPartitions("prefix", "batch_no")
        found = materialize(whole.mapInPandas(ask, entry)
                            .observe(seen, F.count_if(F.col("kind") == "failed").alias("failed")), "answers")
        if seen.get["failed"]:  # a row for each batch
            failed += found.where("kind = 'failed'").select("prefix", "batch_no", "error").collect()
        append_version(found.where("kind <> 'failed'").select(
            "kind", "prefix", "DATA_ID", "SYMBOL_NAME", "batch_no", answer.alias("answer")), ledger)
        if len(failed) >= max_failures:
            break
    if failed:
        some = "; ".join(f"{r.prefix} {r.batch_no}: {r.error}" for r in failed[:3])
        raise ServiceFailed(f"{len(failed)} batches were not answered, for example {some}")
    answers = entries("answer")
    if answers is None:
        return spark.createDataFrame([], fields)
    return answers.join(valid.select("DATA_ID", "prefix"), ["DATA_ID", "prefix"], "left_semi").select("answer.*")


def merge_responses(*responses: DataFrame) -> DataFrame:
    """Union responses by name (missing columns NULL); ids as BIGINT."""
    out = responses[0]
    for r in responses[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out.withColumn("DATA_ID", F.col("DATA_ID").try_cast("bigint"))


def attach_symbols(df: DataFrame, responses: DataFrame, prefix: str | None = None) -> DataFrame:
    """Inner-join responses to the enriched rows by ``DATA_ID`` (one-to-many)."""
    if prefix:
        responses = responses.select(*[F.col(c) if c == "DATA_ID" else F.col(c).alias(prefix + c)
                                       for c in responses.columns])
    return df.join(responses, "DATA_ID", "inner")
