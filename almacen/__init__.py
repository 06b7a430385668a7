"""almacen: a Spark-native retail medallion analytics library.

Bronze (control-table ingest into dated raw Parquet), silver (dedupe, typing,
standardisation, hashing, referential integrity with audited rejects and
quality metrics) and gold (star schema, inventory and returns facts, RFM
segmentation, KPIs and views), all as lazy DataFrame functions.
"""

__version__ = "0.1.0"
