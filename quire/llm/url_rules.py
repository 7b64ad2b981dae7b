"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a verdict and a pattern over the address `host + path` (host in lower
case, without scheme, query and fragment). Host rules (`example.org/en/`) fit
their host, all its subdomains and every path that starts with theirs; glob
rules (`*`: any run) fit anywhere in the address. Each rule compiles to one
regular expression and to its literal tokens: letter-digit runs that stand
between separators in every address the rule fits. The rule is filed under the
one of them that the fewest urls hold (counted over all urls); a url's tokens
fetch its candidate rules, and only those run their regular expressions. The
longest fitting rule wins, host rules before glob rules; equal lengths are ties,
broken by text.

Everything is DataFrame expressions. An index of up to MAX_INLINE_RULES rules is
a literal map, looked up inside the row without a shuffle; a larger one is
joined on the token, with the urls' hot tokens split by adaptive execution.

A null url, or one without `://`, has empty host and path and gets the default
verdict. Repeated rows are judged alike. Other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_INLINE_RULES = 2_000
#: Token of rules without a literal one; every url holds it.
ALWAYS = ""
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_RULE = "struct<verdict:string,rule:string,rank:int,size:int,regex:string>"


@dataclass(frozen=True)
class Rule:
    verdict: str   # allow or block
    pattern: str   # host and path prefix, or a glob if `glob`
    glob: bool = False

    @property
    def regex(self) -> str:
        if self.glob:
            return "(?s)" + ".*".join(re.escape(x) for x in self.pattern.split("*"))
        return r"(?s)^(?:[^/]*\.)?" + re.escape(self.pattern)

    @property
    def tokens(self) -> list[str]:
        """Literal tokens of every address that the rule fits."""
        text = self.pattern if self.glob else "/" + self.pattern
        found = []
        for m in re.finditer(r"[A-Za-z0-9]+", text):
            before, after = text[m.start() - 1:m.start()], text[m.end():m.end() + 1]
            if before and before != "*" and after and after != "*":
                found.append(m[0])
        return sorted(set(found))


#: The library's own rules where no rule list decides: downloads and session or tracking paths.
DEFAULT_GLOBS = [Rule("block", p, True) for p in (
    "/wp-login.", "/cgi-bin/", "/cart/", "/checkout/", "/login/", "/signup/", "*.exe", "*.zip", "*.iso", "/adserver/")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER)
    path = F.regexp_extract(url, _PARTS, 2)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _tokens(address: Column) -> Column:
    return F.concat(F.array_distinct(F.regexp_extract_all(address, F.lit("([A-Za-z0-9]+)"), F.lit(1))),
                    F.array(F.lit(ALWAYS)))


def rule_index(addresses: DataFrame, rules: list[Rule]) -> list[tuple[str, Rule]]:
    """(token, rule): each rule under the literal token that the fewest rows hold.
    One aggregation over all rows; its result has one row per rule token at most."""
    wanted = sorted({t for r in rules for t in r.tokens})
    spark = addresses.sparkSession
    counts: dict[str, int] = {}
    if wanted:
        literal = F.broadcast(spark.createDataFrame([(t,) for t in wanted], "token string"))
        counts = {r["token"]: r["n"] for r in addresses.select(F.explode(_tokens(F.col("address"))).alias("token"))
                  .join(literal, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [(min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default=ALWAYS), r) for r in rules]


def _as_struct(r: Rule) -> Column:
    return F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.pattern).alias("rule"), F.lit(int(not r.glob)).alias("rank"),
                    F.lit(len(r.pattern)).alias("size"), F.lit(r.regex).alias("regex"))


def judge_urls(pages: DataFrame, rules: list[Rule], keys: list[str], default: str = "allow",
               globs: list[Rule] | None = None, max_inline: int = MAX_INLINE_RULES) -> DataFrame:
    """`keys` of `pages`, host, path, rule (the host rule that decided, else null)
    and verdict, one row per row of `pages` (which has a column url)."""
    every = [*rules, *(DEFAULT_GLOBS if globs is None else globs)]
    host, path = host_and_path(F.col("__url"))
    base = pages.select(*keys, F.col("url").cast("string").alias("__url")) \
        .select(*keys, host.alias("host"), path.alias("path"))
    seen = base.withColumn("address", F.concat("host", "path"))
    best = F.array_max(F.transform("fits", lambda c: F.struct(c["rank"].alias("rank"), c["size"].alias("size"),
                                                              c["rule"].alias("rule"), c["verdict"].alias("verdict"))))
    shown = [*keys, "host", "path", F.when(F.col("best.rank") == 1, F.col("best.rule")).alias("rule"),
             F.coalesce("best.verdict", F.lit(default)).alias("verdict")]
    if not every:
        return seen.select(*keys, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    index = rule_index(seen, every)
    if len(every) <= max_inline:
        by_token: dict[str, list[Column]] = {}
        for token, r in index:
            by_token.setdefault(token, []).append(_as_struct(r))
        table = F.create_map(*[x for t, found in by_token.items() for x in (F.lit(t), F.array(*found))])
        candidates = F.flatten(F.filter(F.transform(_tokens(F.col("address")), lambda t: F.try_element_at(table, t)),
                                        lambda x: x.isNotNull()))
        fits = F.filter(candidates, lambda c: F.rlike(F.col("address"), c["regex"]))
        return seen.withColumn("fits", fits).withColumn("best", best).select(*shown)
    spark = pages.sparkSession
    rows = [(t, (r.verdict, r.pattern, int(not r.glob), len(r.pattern), r.regex)) for t, r in index]
    filed = spark.createDataFrame(rows, f"token string, r {_RULE}")
    addresses = seen.select("address").distinct()
    fitting = addresses.select("address", F.explode(_tokens(F.col("address"))).alias("token")).join(filed, "token") \
        .where(F.expr("address rlike r.regex")) \
        .groupBy("address").agg(F.max(F.struct("r.rank", "r.size", "r.rule", "r.verdict")).alias("best"))
    return seen.join(fitting, "address", "left").select(*shown)
