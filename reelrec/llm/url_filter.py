"""URL filters: rules by host and path, then a blocked Bloom filter of listed URLs in front of
an exact hash join.

``judge`` gives each URL the verdict of the longest rule that fits it.  The other URLs go to the
list: their canonical form is looked up in a blocked Bloom filter (one 256-bit block a URL, one
bit in each of its eight 32-bit lanes).  A URL that misses is not listed, for certain.  Possible
hits go on to a hash join with the list, which removes the false positives, so the verdict is
exact.

Only DataFrame functions run.  The filter is a table (block, four longs) built by ``bit_or``; it
has 40 bytes for at most 16 listed URLs.  It is broadcast only when its size, known from the
number of blocks, is at most ``broadcast_bytes``; beyond that the lookup is a shuffled join on the
block number.  The URLs that pass are few, so only they are shuffled by URL.  A URL that a third
of the rows share makes one hot key of that last join, which adaptive execution splits: the
listed side has each URL once.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule and
is never listed; repeated rows are judged one by one; an empty list blocks nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrec.llm.common import ascii_lower, table, written

BITS_PER_URL = 16
BROADCAST_BYTES = 32 << 20
BLOCK_BYTES = 40             # block number and four longs


@dataclass(frozen=True)
class Rule:
    verdict: str             # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host in lower case without a default port, and path without ``.html`` or a final slash.
    Scheme, query and fragment don't count.  Null if there is no ``://``."""
    host = F.regexp_replace(host_of(url), r":(80|443)\z", "")
    path = F.regexp_replace(path_of(url), r"(\.html?)?/*\z", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (of equals, the one with the longer host)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host))):     # the last that fits wins
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.name)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _lanes(url: Column) -> list[Column]:
    """The bits of a URL in its block: four longs with two 32-bit lanes each, a bit in each lane."""
    h = F.xxhash64(url, F.lit("lane"))
    bit = [F.shiftrightunsigned(h, 5 * k).bitwiseAND(F.lit(31)).cast("int") for k in range(8)]
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, bit[2 * j]).bitwiseOR(F.call_function("shiftleft", one, bit[2 * j + 1] + 32))
            for j in range(4)]


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """``url`` -> one row ``_block, _w0.._w3`` per block that has a bit."""
    lanes = listed.select(F.pmod(F.xxhash64("url"), F.lit(blocks)).alias("_block"),
                          *[w.alias(f"_w{j}") for j, w in enumerate(_lanes(F.col("url")))])
    return lanes.groupBy("_block").agg(*[F.bit_or(f"_w{j}").alias(f"_w{j}") for j in range(4)])


def possible_hits(urls: DataFrame, filter_rows: DataFrame, blocks: int,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``urls`` with ``_canon`` -> the same with ``_maybe``: false only if surely not listed."""
    if blocks * BLOCK_BYTES <= broadcast_bytes:
        filter_rows = F.broadcast(filter_rows)
    u = urls.withColumn("_block", F.pmod(F.xxhash64("_canon"), F.lit(blocks)))
    j = u.join(filter_rows, "_block", "left")
    hit = F.col("_canon").isNotNull()
    for k, lane in enumerate(_lanes(F.col("_canon"))):
        hit = hit & (F.col(f"_w{k}").bitwiseAND(lane) == lane)
    return j.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_block", *[f"_w{k}" for k in range(4)])


def judge(urls: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES,
          bits_per_url: int = BITS_PER_URL, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``page_id, url`` and ``listed`` (``url``: raw URLs, repeats and nulls allowed) ->
    ``page_id, host, path, rule, verdict, listed`` for every row."""
    listing = written(listed.select(canonical(F.col("url")).alias("url")).where("url is not null").distinct(), "urls")
    n = listing.count()
    blocks = max(1, -(-n * bits_per_url // 256))
    bloom = bloom_filter(listing, blocks)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    u = urls.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    u = u.select("page_id", "host", "path", name.alias("rule"), verdict.alias("_ruled"),
                 canonical(F.col("url")).alias("_canon"))
    ruled = u.where("_ruled is not null").withColumn("_in", F.lit(None).cast("boolean"))
    rest = possible_hits(u.where("_ruled is null"), bloom, blocks, broadcast_bytes)
    missed = rest.where(~F.col("_maybe")).withColumn("_in", F.lit(False))
    exact = listing.select(F.col("url").alias("_canon"), F.lit(True).alias("_exact"))
    hits = (rest.where("_maybe").join(exact, "_canon", "left")
            .withColumn("_in", F.coalesce("_exact", F.lit(False))))
    cols = ["page_id", "host", "path", "rule", "_ruled", "_in"]
    out = ruled.select(*cols).unionByName(missed.select(*cols)).unionByName(hits.select(*cols))
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("_ruled", F.when(F.col("_in"), "block").otherwise("allow")).alias("verdict"),
                      F.col("_in").alias("listed"))


def toxic_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """URLs of the pages whose document (the number that ends their path) is labelled toxic."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(\.html)?/?\z", 1)
    p = pages.select("url", number.alias("_n")).select("url", F.expr("try_cast(_n as bigint)").alias("doc_id"))
    bad = labels.where("toxic = 1").select("doc_id").distinct()
    return p.join(bad, "doc_id", "left_semi").select("url")


def op1_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = toxic_urls(pages, table(spark, sf_dir, "labels"))
    return judge(pages, listed).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = r"""
with p as (
  select page_id, url,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
c as (
  select *, case when contains(url, '://') then regexp_replace(host, ':(80|443)\z', '') || regexp_replace(path, '(\.html?)?/*\z', '') end as canon,
    try_cast(regexp_extract(path, '/([0-9]{1,18})(\.html)?/?\z', 1) as bigint) as n from p),
listed as (select distinct canon from c where n in (select doc_id from labels where toxic = 1) and canon is not null),
rules(verdict, rhost, rpath) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit as (
  select c.page_id, c.url, c.host, c.path, c.canon, r.rhost || r.rpath as rule, r.verdict,
    row_number() over (partition by c.page_id, c.url order by length(r.rhost || r.rpath) desc, length(r.rhost) desc) as k
  from c left join rules r on (c.host = r.rhost or ends_with(c.host, '.' || r.rhost)) and starts_with(c.path, r.rpath))
select page_id, host, path, rule,
  coalesce(verdict, case when canon in (select canon from listed) then 'block' else 'allow' end) as verdict
from fit where k = 1
"""
