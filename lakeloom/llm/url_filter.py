"""URL filters: pattern rules found through their rarest literal token.

A rule is either a host rule (``example.org/en/``: the host, its subdomains,
and paths that start so) or a pattern over the whole lower-cased url, where
``*`` is any run, ``^`` a separator or the end, a leading ``||`` the start of
a host label and ``|`` an end of the url; ``@@`` before a pattern allows. Every
rule is indexed under the one of its literal tokens that is rarest among all
urls; a url's own tokens fetch the candidate rules, and only those run their
regular expressions. Rules without a literal token are candidates always.

Verdict: the longest host rule that fits decides; else a fitting allowing
pattern allows, a fitting blocking pattern blocks, and the rest is allowed.

Edge cases: a null url, or one without ``://``, has an empty host and path
and fits no host rule (a null fits no pattern either); repeated rows each get
their row; an empty table gives an empty table; only the id and url columns
are read, so other columns may have any name.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of rules up to which each task holds the index; more are joined.
INDEX_BYTES = 32 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)
_TOKEN = re.compile("[a-z0-9]+")
_PARTS = re.compile(r"(?s).*?://([^/?#]*)([^?#]*)")

HOST_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: The pattern rules that apply by default, one a line.
RULES_FILE = Path(__file__).with_name("url_rules.txt")


def read_patterns(path: str | Path = RULES_FILE) -> list[str]:
    """The patterns of a filter list.

    Blank lines, comments (``!``), headers (``[``) and rules that hide parts
    of pages (``##``) are passed over; rules with options (``$``) raise, as
    they speak of requests and not of addresses.
    """
    lines = [x.strip() for x in Path(path).read_text(encoding="utf-8").splitlines()]
    found = [x for x in lines if x and x[0] not in "![" and "##" not in x and "#@#" not in x]
    if bad := [x for x in found if "$" in x]:
        raise ValueError(f"rules with options: {bad[:5]}")
    return found


#: Options of a list's rules that speak of whole pages, as the addresses at hand are.
PAGE_OPTIONS = frozenset(["document", "doc", "all"])


def read_list(path: str | Path) -> tuple[list[str], Counter]:
    """The patterns of a published filter list, and how many rules are left out for each option.

    Rules whose options all speak of whole pages stay, without them; rules
    with others, such as ``third-party`` or ``script``, speak of requests that
    a page makes and are left out one by one. Options follow the last ``$``.
    """
    kept, left = [], Counter()
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        rule = line.strip()
        if not rule or rule[0] in "![" or "##" in rule or "#@#" in rule or "#?#" in rule:
            continue
        body, mark, options = rule.rpartition("$")
        names = {o.split("=")[0].lstrip("~") for o in options.split(",")} if mark else set()
        if rule.startswith("/") and rule.endswith("/") and len(rule) > 1 or mark and body.startswith("/") and body.endswith("/") and len(body) > 1:
            left["regular expression"] += 1
        elif names <= PAGE_OPTIONS:
            kept.append(body if mark else rule)
        else:
            left.update(names - PAGE_OPTIONS)
    return kept, left


@dataclass(frozen=True)
class Rule:
    text: str
    action: str
    host: bool

    def regex(self, end: str) -> str:
        """Over host + path for a host rule, else over the lower-cased url; ``end`` matches its end."""
        if self.host:
            return r"^(?:[^/]*\.)?" + re.escape(self.text)
        body, head, tail = self.text, "", ""
        if body.startswith("||"):
            body, head = body[2:], r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?"
        elif body.startswith("|"):
            body, head = body[1:], "^"
        if body.endswith("|"):
            body, tail = body[:-1], end
        parts = {"*": ".*", "^": f"(?:[^a-z0-9_.%-]|{end})"}
        return "(?s)" + head + "".join(parts.get(c) or re.escape(c) for c in body) + tail

    @property
    def tokens(self) -> list[str]:
        """Literal runs that any fitting url holds as whole tokens."""
        text = self.text.translate(_FOLD)
        found = []
        for m in _TOKEN.finditer(text):
            before, after = text[: m.start()], text[m.end() :]
            open_left = not before and not self.host or before.endswith("*")
            open_right = not after or after.startswith("*")
            if not open_left and not open_right:
                found.append(m.group())
        return found


def make_rules(hosts: Iterable[tuple[str, str]] = HOST_RULES, patterns: Iterable[str] | None = None) -> list[Rule]:
    rules = [Rule(text, action, True) for action, text in hosts]
    for p in read_patterns() if patterns is None else patterns:
        allow = p.startswith("@@")
        rules.append(Rule(p[2 * allow :].translate(_FOLD), "allow" if allow else "block", False))
    return rules


def split_url(url: str | None) -> tuple[str, str]:
    m = _PARTS.match(url or "")
    return (m[1].translate(_FOLD), m[2]) if m else ("", "")


def _folded(url):
    return F.translate(url, _UPPER, _LOWER)


def _tokens(url):
    return F.array_remove(F.array_distinct(F.split(_folded(url), "[^a-z0-9]+")), "")


def token_counts(urls: DataFrame, rules: list[Rule], url_col: str = "url", index_bytes: int = INDEX_BYTES) -> dict[str, int]:
    """How many urls hold each token that some rule has; all urls count.

    Tokens that no rule has, as most of a url's are, go before anything is
    counted; where the rules' tokens are too many to be sent to the tasks,
    they go after the count.
    """
    wanted = sorted({t for r in rules for t in r.tokens})
    spark = urls.sparkSession
    rows = spark.createDataFrame([(t,) for t in wanted], "token string")
    seen = urls.select(F.explode(_tokens(F.col(url_col))).alias("token"))
    few = sum(map(len, wanted)) + 64 * len(wanted) <= index_bytes
    counts = lambda df: df.groupBy("token").agg(F.count("*").alias("n"))
    counted = counts(seen.join(F.broadcast(rows), "token", "left_semi")) if few else counts(seen).join(rows, "token", "left_semi")
    found = {r.token: r.n for r in counted.collect()}  # no more rows than rule tokens
    return {t: found.get(t, 0) for t in wanted}


def index_rules(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Each rule under its rarest token; under '' if it has none."""
    index: dict[str, list[Rule]] = {}
    for r in rules:
        key = min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default="")
        index.setdefault(key, []).append(r)
    return index


@lru_cache(maxsize=65_536)
def _compiled(rule: Rule) -> re.Pattern:
    return re.compile(rule.regex(r"\Z"))


def _decide(hits: list[Rule]) -> tuple[str | None, str]:
    own = [r for r in hits if r.host]
    if own:
        best = max(own, key=lambda r: len(r.text))
        return best.text, best.action
    return None, "block" if hits and all(r.action == "block" for r in hits) else "allow"


def _match_in_tasks(urls: DataFrame, index: dict[str, list[Rule]]) -> DataFrame:
    shared = urls.sparkSession.sparkContext.broadcast(index)  # at most INDEX_BYTES, checked by the caller

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = shared.value
        for b in batches:
            out = []
            for url in b.column(1).to_pylist():
                host, path = split_url(url)
                folded, hits = (url or "").translate(_FOLD), []
                for t in {"", *_TOKEN.findall(folded)} if url is not None else ():
                    for r in rules.get(t, ()):
                        if _compiled(r).search(host + path if r.host else folded):
                            hits.append(r)
                out.append((host, path, *_decide(hits)))
            cols = [list(c) for c in zip(*out)] or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.string()) for c in cols)], ["id", "host", "path", "rule", "verdict"]
            )

    schema = T.StructType([T.StructField("id", urls.schema["id"].dataType)])
    for name in ("host", "path", "rule", "verdict"):
        schema = schema.add(name, "string")
    return urls.select("id", "url").mapInArrow(run, schema)


def _match_by_join(urls: DataFrame, index: dict[str, list[Rule]]) -> DataFrame:
    """The same by joining distinct urls' tokens with the rules as a table.

    Rules without a token are tried on every url where it lies, so they make
    no join key that all urls share.
    """
    spark = urls.sparkSession
    kind = "text string, action string, on_host boolean, regex string"
    row = lambda r: (r.text, r.action, r.host, r.regex(r"\z"))
    rules = spark.createDataFrame([(t, *row(r)) for t, rs in index.items() if t for r in rs], f"token string, {kind}")
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(_folded(F.regexp_extract("url", whole, 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract("url", whole, 2), F.lit(""))
    once = urls.filter("url is not null").select("url").distinct().withColumns({"host": host, "path": path})
    found = once.withColumn("token", F.explode(_tokens(F.col("url")))).join(rules, "token").drop("token")
    if index.get(""):
        each = F.explode(F.array(*[F.struct(*map(F.lit, row(r))) for r in index[""]]))
        found = found.unionAll(once.withColumn("r", each).select("url", "host", "path", "r.*"))
    fits = F.when(F.col("on_host"), F.concat("host", "path")).otherwise(_folded(F.col("url")))
    hits = found.withColumn("over", fits).filter(F.expr("over rlike regex"))
    size = F.when(F.col("on_host"), F.length("text"))
    best = hits.groupBy("url").agg(
        F.max_by(F.when(F.col("on_host"), F.struct("text", "action")), size).alias("own"),
        F.bool_and(F.col("action") == "block").alias("blocked"),
    )
    verdict = F.coalesce(F.col("own.action"), F.when(F.col("blocked"), "block"), F.lit("allow"))
    return urls.join(best, "url", "left").select(
        "id", host.alias("host"), path.alias("path"), F.col("own.text").alias("rule"), verdict.alias("verdict")
    )


def filter_urls(
    df: DataFrame, rules: list[Rule] | None = None, id_col: str = "page_id", url_col: str = "url",
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """Rows (id, host, path, rule, verdict), one per row of ``df``.

    The index travels to the tasks if its pickled size is at most
    ``index_bytes``; a larger rule set is joined as a table instead.
    """
    rules = make_rules() if rules is None else rules
    urls = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    index = index_rules(rules, token_counts(urls, rules, index_bytes=index_bytes))
    if len(pickle.dumps(index)) <= index_bytes:
        return _match_in_tasks(urls, index)
    return _match_by_join(urls, index)


def op1_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return filter_urls(pages).withColumnRenamed("id", "page_id")


def oracle_sql() -> str:
    """SQL for the query; it translates the listed patterns by itself."""
    listed = ", ".join("('{}')".format(p.replace("'", "''")) for p in read_patterns())
    return rf"""
WITH parts AS (
  SELECT page_id, lower(coalesce(url, '')) AS folded,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(action, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
listed(line) AS (VALUES {listed}),
stripped AS (SELECT line, starts_with(line, '@@') AS allows, regexp_replace(line, '^@@', '') AS body FROM listed),
patterns AS (
  SELECT allows, CASE WHEN starts_with(body, '||') THEN '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?' WHEN starts_with(body, '|') THEN '^' ELSE '' END
    || replace(replace(regexp_escape(regexp_replace(regexp_replace(body, '^\|\|?', ''), '\|$', '')), '\*', '.*'), '\^', '([^a-z0-9_.%-]|$)')
    || CASE WHEN ends_with(body, '|') THEN '$' ELSE '' END AS regex FROM stripped),
fits AS (
  SELECT page_id, bool_or(allows) AS allowed FROM parts JOIN patterns ON regexp_matches(folded, regex, 's') GROUP BY page_id),
judged AS (
  SELECT parts.*,
    (SELECT max_by(struct_pack(text := h || p, action := action), length(h || p)) FROM rules
     WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS own
  FROM parts)
SELECT page_id, host, path, own.text AS rule,
  coalesce(own.action, CASE WHEN allowed = false THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN fits USING (page_id)
"""
