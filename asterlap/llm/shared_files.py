"""Files of the shared folder that tasks read or write themselves, wherever that folder is."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or of an absolute local path."""
    return fs.FileSystem.from_uri(uri)


def read_partition(uri: str, column: str, value, columns: dict[str, pa.DataType]) -> pa.Table:
    """Rows of one partition of a Parquet table that Spark has written with ``partitionBy(column)``."""
    system, path = opened(f"{uri}/{column}={value}")
    files = [f.path for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.base_name.startswith("part-")]
    if not files:
        return pa.schema(columns).empty_table()
    return pa.concat_tables([pq.read_table(f, filesystem=system, columns=list(columns), partitioning=None) for f in files])
