"""The additive word table in a database: a staged batch and one server-side upsert.

Spark writes the batch to a staging table in parallel. The statements then run
in one transaction on the database, through whatever connection the caller has,
and a ledger row makes a replayed batch a no-op.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# The columns of the monthly table.
_TABLE_COLUMNS = (
    "id INT NOT NULL AUTO_INCREMENT, word VARCHAR(64) NOT NULL, "
    "count INT DEFAULT 0, date DATE NOT NULL, PRIMARY KEY (id), UNIQUE KEY word (word, date)"
)


def stage_batch(counts: DataFrame, options: dict[str, str], staging: str) -> None:
    """Write ``word, date, n`` to the staging table, replacing what an earlier try left."""
    (
        counts.select("word", "date", "n")
        .write.format("jdbc")
        .options(**options)
        .option("dbtable", staging)
        .mode("overwrite")
        .save()
    )


def upsert_statements(staging: str, month: str, query: str, batch: int) -> list[str]:
    """The statements of one transaction that adds the staged rows of ``month``."""
    table = f"word_count_{month}"
    seen = f"SELECT 1 FROM batch_ledger WHERE query = '{query}' AND month = '{month}' AND batch = {batch}"
    return [
        f"CREATE TABLE IF NOT EXISTS {table} ({_TABLE_COLUMNS})",
        "CREATE TABLE IF NOT EXISTS batch_ledger "
        "(query VARCHAR(64), month CHAR(6), batch BIGINT, PRIMARY KEY (query, month, batch))",
        f"INSERT INTO {table} (word, count, date) "
        f"SELECT word, n, date FROM {staging} "
        f"WHERE DATE_FORMAT(date, '%Y%m') = '{month}' AND NOT EXISTS ({seen}) "
        "ON DUPLICATE KEY UPDATE count = count + VALUES(count)",
        f"INSERT IGNORE INTO batch_ledger VALUES ('{query}', '{month}', {batch})",
    ]
