"""Card transactions to a training table without personal data, with a lineage record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators import anomaly, binning, fraud, privacy
from lakeops.operators import timeline as tl
from lakeops.session import materialize
from lakeops.sources import sinks

ANOMALY_FEATURES = ["amount", "hour_of_day", "time_since_last_txn", "transaction_sequence"]


def secure_ml_table(txns: DataFrame, secret: str, config: Mapping[str, Mapping], categories: DataFrame, contamination: float = 0.01, floor: int = tl.HOT_ROWS, digits: int | None = None) -> DataFrame:
    """Tokens, amount bins, merchant codes, time and sequence features, anomaly scores (rounded if asked)."""
    clear = anomaly.sequence_features(txns, ["account_id"], ["ts", "transaction_id"], "amount", floor=floor)
    binned = binning.percentile_bins(fraud.temporal_features(clear), "amount", edges_from=txns)
    encoded = binning.encode_merchants(binned, "mcc", categories)
    # the percentile passes below read this table several times: write it once
    ready = materialize(privacy.tokenize_table(encoded, secret, config), "secure-features")
    return anomaly.row_anomaly(ready, ANOMALY_FEATURES, contamination, digits)


def write_with_lineage(df: DataFrame, inputs: list[str], output: str, job: str, as_of: str) -> DataFrame:
    """Write date partitions; counters come from the writing job itself. Returns the lineage row."""
    rows, seen = sinks.observed(
        df, job, records_written=F.count(F.lit(1)), anomalies=F.count(F.when(F.col("is_anomaly"), 1))
    )
    sinks.write_partitioned(rows, output, ["date"])
    record = sinks.run_record(df.sparkSession, job, as_of, seen.get)
    return record.withColumns({"input_paths": F.array(*[F.lit(p) for p in inputs]), "output_paths": F.array(F.lit(output))})
