"""Schemas of the event log and of the tables derived from it."""

from pyspark.sql import types as T

TAGS = T.ArrayType(T.ArrayType(T.StringType()))
EVENTS = T.StructType([T.StructField("id", T.StringType()), T.StructField("pubkey", T.StringType()), T.StructField("created_at", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("tags", TAGS), T.StructField("content", T.StringType()), T.StructField("sig", T.StringType())])
LEDGER = T.StructType([T.StructField("pubkey", T.StringType()), T.StructField("content_synced_at", T.LongType()), T.StructField("outbox_checked_at", T.LongType())])
CURSORS = T.StructType([T.StructField("relay", T.StringType()), T.StructField("scope", T.StringType()), T.StructField("last_synced_at", T.LongType())])
EVENTS_BY_RELAY = T.StructType([T.StructField("relay", T.StringType()), *EVENTS.fields])

PROFILE, NOTE, FOLLOWS, DELETION, VANISH, RELAY_LIST, TRUST_LIST, INDEXER, SCORE = 0, 1, 3, 5, 62, 10002, 10040, 10086, 30382
