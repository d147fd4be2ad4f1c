"""Column types of the tables that stages exchange.

Fixed values: names, types and aliases are those of the exchanged files.
"""

from __future__ import annotations

from pyspark.sql.types import IntegerType, ShortType, StringType, StructField, StructType

#: Alignments of one genome, one row each; every column may be null.
QC = StructType(
    [
        StructField("Read", StringType()), StructField("BC", StringType()), StructField("MAPQ", ShortType()), StructField("as_", IntegerType()),
        StructField("NM", IntegerType()), StructField("XAcount", ShortType()), StructField("frag_loc", StringType()),
    ]
)

ASSIGN_COLUMNS = ("Read", "BC", "Genome", "as_", "MAPQ", "NM", "XAcount", "assigned_class", "p_as", "p_mq", "frag_loc")

#: Other names under which files carry the same column, lower-cased.
ALIASES = {"barcode": "BC", "bc": "BC", "read_id": "Read", "read": "Read", "genome": "Genome", "as": "as_", "mapq": "MAPQ", "nm": "NM", "xacount": "XAcount"}
