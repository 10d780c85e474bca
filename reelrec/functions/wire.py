"""H8: rating rows <-> ``userId%movieId%rating`` message text (key = topic name)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrec import schemas
from reelrec.functions.parse import ParseResult, parse_delimited
from reelrec.functions.text import java_trim

DEFAULT_TOPIC = "real-time"     # fixed value: the reference's topic
SEP = "%"


def encode(df: DataFrame, topic: str = DEFAULT_TOPIC,
           fields: tuple[str, ...] = ("userId", "movieId", "rating")) -> DataFrame:
    """Row -> (key, value) message; numbers rendered as Java's ``toString`` does."""
    return df.select(F.lit(topic).alias("key"),
                     F.concat_ws(SEP, *[F.col(c).cast("string") for c in fields]).alias("value"))


def decode(messages: DataFrame, *, on_error: str = "quarantine", value_col: str = "value") -> ParseResult:
    """(key, value) message -> (userId, movieId, rating).  The user is field 0 (D4 ruling).

    Null, empty and malformed values are quarantined instead of failing the batch."""
    lines = messages.select(F.coalesce(F.col(value_col).cast("string"), F.lit("")).alias("value"))
    return parse_delimited(lines, schemas.RATING_TRIPLE, SEP, on_error=on_error,
                           drop_incomplete_lines=False)


def decode_users(messages: DataFrame, *, value_col: str = "value") -> ParseResult:
    """Requests: only field 0, the user, is needed to answer one.  Messages without a user id
    are set aside with a reason."""
    text = F.coalesce(F.col(value_col).cast("string"), F.lit(""))
    user = java_trim(F.element_at(F.split(text, SEP, 2), 1)).try_cast("int")
    staged = messages.select(F.inline(F.array(F.struct(text.alias("value"), user.alias("userId")))))
    return ParseResult(staged.where("userId is not null").select("userId"),
                       staged.where("userId is null").select("value", F.lit("bad int: userId").alias("reason")))
