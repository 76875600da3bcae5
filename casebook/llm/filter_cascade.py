"""URL rules by a cascade of Bloom filters.

The first filter encodes the listed keys. Some other keys of the corpus pass it as well; because all keys of the corpus are
known, these can be found, and the second filter encodes them. Listed keys that pass the second filter by chance go into
a third, and so on until nothing is left. For every key of that universe membership is then exact, and asking for it takes a few
hashes in an expression: no join, and nothing to ship but filters whose size follows the list (the first filter is
made so exact that about as many other keys pass it as are listed).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import table
from casebook.sources.work import Work

#: Rules of a list at most; the list and its filters are sent to all tasks.
MOST_RULES = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Level:
    seed: int
    bits: int
    hashes: int
    words: dict[int, int] = field(default_factory=dict)

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.seed * 64 + n), key), F.lit(self.bits)) for n in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        table = F.lit([self.words.get(n, 0) for n in range(-(-self.bits // 64))])
        out = F.lit(True)
        for p in self.positions(key):
            word = F.get(table, F.shiftright(p, 6).cast("int"))
            out = out & (F.getbit(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
        return out


def _level(keys: DataFrame, seed: int, n: int, rate: float) -> Level:
    """A filter of the ``n`` keys that lets others pass at about ``rate``."""
    bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    level = Level(seed, bits, max(1, round(bits / n * math.log(2))))
    at = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("p"))
    found = at.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(p, 64) as int))")).alias("bits"))
    level.words = {r["word"]: r["bits"] for r in found.collect()}  # a row for 64 bits of the filter
    return level


@dataclass
class Cascade:
    levels: list[Level]

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for n in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[n].passes(key), out).otherwise(F.lit(n % 2 == 1))
        return out


def build(listed: DataFrame, universe: DataFrame, work: Work) -> Cascade:
    """``listed`` and ``universe``: distinct ``key``; the list is part of the universe or not, and has a bounded size."""
    inside = work.keep(listed, "listed")
    n = inside.count()
    if n > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} listed keys")
    if not n:
        return Cascade([])
    outside = work.keep(universe.join(F.broadcast(inside), "key", "left_anti"), "others")
    others = outside.count()
    rate, levels = min(0.5, n / (math.sqrt(2) * max(1, others))), []
    own, rest = inside, outside
    while n:
        levels.append(_level(own, len(levels) + 1, n, rate))
        own, rest = work.keep(rest.where(levels[-1].passes(F.col("key"))), f"passed-{len(levels)}"), own
        n, rate = own.count(), 0.5
    return Cascade(levels)


def with_host_and_path(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; both empty for a null url or one without ``://``."""
    url = F.coalesce(urls[url_col].cast("string"), F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return urls.withColumns({"host": F.translate(host, _UPPER, _LOWER), "path": path})


def keys_of(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """All keys by which a rule of at most so many host labels and path slashes can fit: a domain above or equal to the
    host, and the path up to one of its slashes."""
    parts, steps = F.split(host, r"\."), F.split(path, "/")
    n, m = F.least(F.size(parts), F.lit(labels)), F.least(F.size(steps) - 1, F.lit(slashes))
    hosts = F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(parts, -k, k), "."))
    paths = F.when(m > 0, F.transform(F.sequence(F.lit(1), m), lambda k: F.concat(F.array_join(F.slice(steps, 1, k), "/"), F.lit("/")))).otherwise(F.array())
    return F.array_distinct(F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p)))))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], otherwise: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` are (verdict, host, path); a path starts and ends with a slash. The longest fitting rule decides, and
    ``otherwise`` where the cascade holds none of a url's keys. Null urls have no keys; repeated rows stay.
    """
    spark = pages.sparkSession
    if bad := [r for r in rules if not (r[2].startswith("/") and r[2].endswith("/") and r[1])]:
        raise ValueError(f"a rule needs a host and a path that starts and ends with a slash: {bad[0]}")
    verdicts = {host + path: verdict for verdict, host, path in rules}
    work = Work(spark)
    labels = max((r[1].count(".") + 1 for r in rules), default=1)
    slashes = max((r[2].count("/") for r in rules), default=1)
    rows = with_host_and_path(pages.select(pages[id_col].alias(id_col), pages[url_col].alias(url_col)), url_col)
    keys = keys_of(F.col("host"), F.col("path"), labels, slashes)
    keyed = work.keep(rows.select(id_col, "host", "path", keys.alias("_keys")), "keys")
    universe = keyed.select(F.explode("_keys").alias("key")).distinct()
    make = lambda some: spark.createDataFrame([(k,) for k in some], "key string")
    listed = build(make(verdicts), universe, work)
    blocked = build(make(k for k, v in verdicts.items() if v == "block"), make(verdicts), work)
    fitting = F.transform(F.filter("_keys", listed.holds), lambda k: F.struct(F.length(k).alias("n"), k.alias("key")))
    judged = keyed.select(id_col, "host", "path", F.array_max(fitting)["key"].alias("rule"))
    verdict = F.when(F.col("rule").isNull(), F.lit(otherwise)).when(blocked.holds(F.col("rule")), "block").otherwise("allow")
    return judged.withColumn("verdict", verdict)


RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op6_filter_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), RULES)


OP6_SQL = r"""
with rules(verdict, host, path) as (
  values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), rest as (
  select page_id, case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), cut as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw, rest from rest
), parts as (
  select row_number() over () as n, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path
  from cut
), best as (
  select n, max_by(r.host || r.path, length(r.host || r.path)) as rule, max_by(r.verdict, length(r.host || r.path)) as verdict
  from parts p join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
  group by n
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join best using (n)
"""
