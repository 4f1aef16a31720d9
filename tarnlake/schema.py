"""Schemas of the tables that the engine reads and writes."""

from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType


def _table(**columns) -> StructType:
    """Columns by name, each (type, nullable)."""
    return StructType([StructField(name, kind, null) for name, (kind, null) in columns.items()])


_SIZE = ArrayType(LongType(), False)

SUCCESSES = _table(
    uuid=(StringType(), False),
    source_id=(StringType(), False),
    identifier=(StringType(), False),
    is_license_full=(BooleanType(), False),
    license=(StringType(), True),
    source=(StringType(), True),
    title=(StringType(), True),
    original_size=(_SIZE, False),
    resized_size=(_SIZE, False),
    hashsum_original=(StringType(), False),
    hashsum_resized=(StringType(), False),
    image=(BinaryType(), False),
    server_name=(StringType(), True),
    partition_id=(IntegerType(), True),
)
ERRORS = _table(uuid=(StringType(), True), identifier=(StringType(), True), retry_count=(IntegerType(), True), error_code=(IntegerType(), True), error_msg=(StringType(), True), server_name=(StringType(), True), partition_id=(IntegerType(), True))
PROFILES = _table(server_name=(StringType(), True), total_batches=(IntegerType(), True), success_count=(IntegerType(), True), error_count=(IntegerType(), True), rate_limit=(IntegerType(), True))
LEDGER = _table(server_name=(StringType(), True), partition_id=(IntegerType(), True), status=(StringType(), True), run_id=(LongType(), True))
ASSIGNMENTS = _table(rank=(IntegerType(), True), server_name=(StringType(), True), partition_id_from=(IntegerType(), True), partition_id_to=(IntegerType(), True), main_rank=(IntegerType(), True), rate_limit=(IntegerType(), True))
SCHEDULE = _table(schedule_id=(IntegerType(), True), server_name=(StringType(), True), total_batches=(IntegerType(), True), process_per_node=(IntegerType(), True), nodes=(IntegerType(), True))
RATES = _table(server_name=(StringType(), True), rate=(DoubleType(), True))
