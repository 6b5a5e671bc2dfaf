"""Schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

MEMBER = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("title", T.StringType()),
])
MEMBERS = T.ArrayType(MEMBER)

SOURCE_TAGS = T.StructType([
    T.StructField("officers", T.StringType()),
    T.StructField("board_members", T.StringType()),
])

REGISTRY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("website", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("headquarters_location", T.StringType()),
    T.StructField("founded_date", T.DateType()),
    T.StructField("description", T.StringType()),
    T.StructField("officers", MEMBERS),
    T.StructField("board_members", MEMBERS),
    T.StructField("data_source", SOURCE_TAGS),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

# The eleven columns a registry scan returns.
REGISTRY_COLUMNS = [
    "id", "website", "company_name", "ticker", "exchange", "headquarters_location",
    "founded_date", "description", "officers", "board_members", "data_source",
]

# Longest allowed value per registry column.
REGISTRY_LENGTHS = {
    "website": 255,
    "company_name": 255,
    "ticker": 50,
    "exchange": 50,
    "headquarters_location": 255,
}

CONTACT = T.StructType([
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
])
PERSON = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
])
PEOPLE = T.ArrayType(PERSON)

# Spans a recogniser reports: which section, what name, where it starts.
SPAN = T.StructType([
    T.StructField("section", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("start", T.IntegerType()),
])
SPANS = T.ArrayType(SPAN)

# One model answer.
RESPONSE = T.StructType([
    T.StructField("officers", MEMBERS),
    T.StructField("board_members", MEMBERS),
])
RESPONSE_PERSON = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("bio", T.StringType()),
])
