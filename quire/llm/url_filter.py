"""URL rules found through their rarest literal token.  DataFrame functions only.

A rule is an action, a host and a path prefix; it fits its host and all
subdomains when the URL's path starts with the rule's path, and of several
fitting rules the longest wins.  Every rule is one regular expression over
``host || path``.  Trying each rule on each URL costs rules x URLs matches, so
rules are indexed: a rule is filed under that one of its whole literal tokens
(runs of ``[0-9a-z]``) which the fewest URLs hold, a URL's own tokens fetch the
filed rules, and only those run their expression.  The index sits in the plan as
a literal map, in blocks of ``block`` rules, so neither a shuffle nor a join is
needed and a host that holds a third of all rows costs nothing extra.

Cases: a null URL or one without ``://`` has an empty host and path and fits no
rule; an empty table gives an empty result; repeated rows each get their own
answer; other columns stay as they are, and results go to one new struct column.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ascii_lower, fresh

TOKEN = "[0-9a-z]+"


@dataclass(frozen=True)
class UrlRule:
    action: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        quoted = "".join(c if c.isalnum() and c.isascii() else "\\x{%x}" % ord(c) for c in self.text)
        return rf"^(?:[^/]*\.)?{quoted}"

    def whole_tokens(self) -> list[str]:
        """Tokens that any fitting URL holds as whole tokens; a token at the end of
        the path may go on in the URL and is left out."""
        text = self.text.translate(_LOWER)
        return sorted({m[0] for m in re.finditer(TOKEN, text) if m.end() < len(text)})


_LOWER = {c: c + 32 for c in range(65, 91)}


def host_of(url: Column) -> Column:
    """Lower-cased text after the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def tokens_of(host: Column, path: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(F.concat(host, path)), F.lit(TOKEN), 0))


def token_counts(urls: DataFrame, url_col: str, wanted: list[str]) -> dict[str, int]:
    """In how many URLs each wanted token stands (at most one row per wanted token comes back)."""
    if not wanted:
        return {}
    c = F.col(url_col)
    held = F.array_intersect(tokens_of(host_of(c), path_of(c)), F.array(*map(F.lit, wanted)))
    rows = urls.select(F.explode(held).alias("token")).groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


def apply_url_rules(
    urls: DataFrame,
    rules: list[UrlRule],
    url_col: str = "url",
    default: str = "allow",
    out: str = "url_rule",
    block: int = 256,
) -> tuple[DataFrame, str]:
    """``urls`` with a struct column (host, path, rule, verdict); returns the frame
    and that column's name (``out``, or a longer one where that is taken)."""
    out = fresh(urls, out)
    counts = token_counts(urls, url_col, sorted({t for r in rules for t in r.whole_tokens()}))
    c = F.col(url_col)
    host, path = host_of(c), path_of(c)
    parts, tmp = urls.withColumn(out, F.struct(host.alias("host"), path.alias("path"))), F.col(out)
    best = F.lit(None).cast("struct<size:int,rule:string,action:string>")
    for at in range(0, len(rules), block):
        best = F.greatest(best, _best_of(tmp["host"], tmp["path"], rules[at : at + block], counts)) if at else _best_of(
            tmp["host"], tmp["path"], rules[:block], counts
        )
    found = fresh(parts, "url_rule_found")
    done = parts.withColumn(found, best).withColumn(
        out,
        F.struct(
            tmp["host"].alias("host"),
            tmp["path"].alias("path"),
            F.col(found)["rule"].alias("rule"),
            F.coalesce(F.col(found)["action"], F.lit(default)).alias("verdict"),
        ),
    )
    return done.drop(found), out


def _best_of(host: Column, path: Column, rules: list[UrlRule], counts: dict[str, int]) -> Column:
    index: dict[str, list[int]] = defaultdict(list)
    always = []  # rules without a whole token are tried on each URL
    for i, r in enumerate(rules):
        tokens = r.whole_tokens()
        if tokens:
            index[min(tokens, key=lambda t: (counts.get(t, 0), t))].append(i)
        else:
            always.append(i)
    ints = lambda xs: F.array(*map(F.lit, xs)).cast("array<int>")
    table = F.array(
        *(
            F.struct(
                F.lit(len(r.text)).alias("size"),
                F.lit(r.text).alias("rule"),
                F.lit(r.action).alias("action"),
                F.lit(r.pattern).alias("pattern"),
            )
            for r in rules
        )
    )
    fetched = ints(always)
    if index:
        filed = F.create_map(*(x for t, ids in index.items() for x in (F.lit(t), ints(ids))))
        keys = F.array(*map(F.lit, index))
        hits = F.transform(F.array_intersect(tokens_of(host, path), keys), lambda t: F.element_at(filed, t))
        fetched = F.concat(F.flatten(hits), fetched)
    full = F.concat(host, path)
    fits = F.filter(
        F.transform(fetched, lambda i: F.get(table, i)), lambda r: F.regexp_like(full, r["pattern"])
    )
    return F.array_max(
        F.transform(
            fits, lambda r: F.struct(r["size"].alias("size"), r["rule"].alias("rule"), r["action"].alias("action"))
        )
    )
