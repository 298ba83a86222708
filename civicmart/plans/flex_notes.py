"""Flex notes: question/answer rows, minus a deny-list of questions, keyed upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.filters import exclude_values
from ..operators.projection import map_fields
from ..sinks.files import write_upsert
from ..sources.files import read_csv_table

# Report columns and their published names.
FIELD_MAPPING = {
    "Flex Notes ID": "flex_note_id",
    "Service Request Number": "service_request_number",
    "Flex Notes Definition ID": "flex_notes_definition_id",
    "Service Request ID": "service_request_id",
    "Flex Question": "flex_question",
    "Flex Answer": "flex_answer",
}

# Questions that are never published.
IGNORED_QUESTIONS = [
    "Mobile Apps Reporter Information",
    "Provide license plate number of vehicle, if known.",
    "*What are the last 4 digits of the card number that you used for this transaction?",
    "Enter APD  # if known (Case #, Officer #, etc.).",
    "Provide User ID from ParkATX App (If user ID is unavailable, type N/A)",
    "What are the last 4 digits of the card number that you used for this transaction?",
    "What is the 9-digit citation number (top line)?",
]

SCHEMA = (
    "`Flex Notes ID` bigint, `Service Request Number` string, `Flex Notes Definition ID` bigint, "
    "`Service Request ID` bigint, `Flex Question` string, `Flex Answer` string"
)


def transform_flex_notes(raw: DataFrame) -> DataFrame:
    """Project to the published columns and drop denied questions (a null question is kept)."""
    return exclude_values(map_fields(raw, FIELD_MAPPING, strict=True), "flex_question", IGNORED_QUESTIONS, keep_null=True)


def flex_notes_job(spark: SparkSession, csv_path: str, target_path: str, versioned: bool = False) -> DataFrame:
    """Read the flex-notes export, clean it, upsert on ``flex_note_id``."""
    rows = transform_flex_notes(read_csv_table(spark, csv_path, schema=SCHEMA, multiLine=True))
    return write_upsert(rows, target_path, keys=["flex_note_id"], versioned=versioned)
