"""Schemas of the entity-resolution data model."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Columns of a source file, all strings.
ENTITY_COLUMNS = ("entity_id", "business_name", "business_address", "country")
ENTITY = StructType([StructField(c, StringType()) for c in ENTITY_COLUMNS])
PAIR = StructType([StructField("s1", LongType()), StructField("tgt", LongType())])
MATCH_HEADER = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_HEADER = ("source1_entity_id", "candidate_entity_ids")
KEY_TYPES = ("name_exact", "name_sig", "name_nospace", "name_bi", "name_tok", "addr_tok", "addr_bi", "house", "house_norm", "postal")
EXACT_TYPES = KEY_TYPES[:3]
