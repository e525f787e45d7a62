"""Incremental runs over the landing folder with Structured Streaming.

A nightly run normally re-reads every landed file of an endpoint.  Run as a
stream with ``trigger(availableNow=True)``, the file source remembers (in its
checkpoint, kept next to the store) which files were already applied, so each
run feeds only the new files -- as one or more micro-batches -- to the same
table update, then stops.

Every row keeps the fetch time of its file, so of two fetches in one micro-batch
the newer counts, as in a batch run, and unreadable texts go to the rejects.

A micro-batch replayed after a failure leaves the same rows: prices, profiles,
statements and series are keyed rows of their own, and earnings, whose periods
follow from the ranks of all reports of an asset, are aligned from the batch and
the reports that the store keeps of its symbols; earlier files are not read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sparkledger.plans.pipelines import Ledger
from sparkledger.sources.landing import landed_texts, parse_records


def _both_statement_tables(ledger: Ledger, rows: DataFrame) -> dict:
    periods = ledger.update_reporting_period(payload=rows)
    return {"reporting_period": periods, **ledger.update_statement("income_statement", payload=rows)}


ENDPOINT_UPDATES: dict[str, Callable[[Ledger, DataFrame], dict]] = {
    "cpi": lambda ledger, docs: ledger.update_cpi(documents=docs),
    "search": lambda ledger, rows: ledger.update_asset(payload=rows),
    "profile": lambda ledger, rows: ledger.update_equity_profile(payload=rows),
    "income_statement": _both_statement_tables,
    "balance_sheet_statement": lambda ledger, rows: ledger.update_statement("balance_sheet_statement", payload=rows),
    "cash_flow_statement": lambda ledger, rows: ledger.update_statement("cash_flow_statement", payload=rows),
    "earnings": lambda ledger, rows: ledger.update_earning(payload=rows),
    "historical_price": lambda ledger, rows: ledger.update_eod_price(payload=rows),
}


def run_new_files(
    ledger: Ledger,
    endpoint: str,
    schema: T.StructType,
    update: Callable[[Ledger, DataFrame], dict] | None = None,
    checkpoint: str | None = None,
    max_files_per_batch: int | None = None,
) -> list[dict]:
    """Apply the endpoint's not-yet-seen landing files; return per-batch results.

    ``schema`` lists the payload fields as landed (camelCase; ``SERIES_PAYLOAD_SCHEMA`` for
    ``cpi``).  ``update`` receives the parsed records of the micro-batch, with their
    fetch times and broken texts.  The stream's progress lives under
    ``<store root>/_streams``.
    """
    update = update or ENDPOINT_UPDATES[endpoint]
    reader = ledger.spark.readStream
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    source = landed_texts(reader, f"{ledger.landing}/{endpoint}", ledger.json_lines)
    results: list[dict] = []

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        results.append({"batch": batch_id, **update(ledger, parse_records(batch, schema, ledger.json_lines))})

    query = (
        source.writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint or f"{ledger.store.root}/_streams/{endpoint}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results
