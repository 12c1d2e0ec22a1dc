"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a line of text. ``||host/path`` fits the host and its subdomains where the path starts with that path
(upper and lower case as written); ``@@`` before it allows instead of blocking. Any other line is a pattern over the
address (host, path and query, A-Z lowered): ``*`` stands for any text, ``^`` for a character other than a-z and 0-9
or for an end of the address, ``|`` at an end pins the pattern to that end.

Every rule is filed under one of its literal tokens: a run of a-z and 0-9 that any address it fits holds as a whole
token. Of a rule's tokens the one is taken that the fewest URLs of the table hold, so common tokens (``com``, ``www``)
fetch few rules. A URL's tokens fetch candidate rules, and only those run their regular expression. A rule without
such a token is a candidate of every URL.

Where the rules are at most ``MAX_BROADCAST`` bytes (measured), the index goes to every task and no URL is shuffled.
A larger rule set is joined by token, with the same results.

Which rule counts: of the host rules that fit, the longest (then the longer host, then block). Without one, an
allowing pattern that fits comes before a blocking one, each time the first in code-point order.

Defined results: a null URL or one without ``://`` has an empty host and path and fits nothing, so it is allowed;
equal rows are judged alike; a long URL is judged whole (each piece between two ``*`` is searched once, forward);
no rules allow everything; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.storage import written
from hourglass.llm.text import slices

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TOKEN = "[a-z0-9]+"
EDGE = "[^a-z0-9]"
MAX_BROADCAST = 32 << 20
RULE_SCHEMA = "line string, kind string, verdict string, rule string, host string, regex string, tokens array<string>"

#: Addresses that web corpora are commonly cleaned of: gambling, pills, adult pages, link farms, advertising and
#: log-in or machine pages without prose.
PATTERNS = (
    "^casino^", "^casinos^", "^poker^", "^bets^", "^betting^", "^jackpot^", "^slots^*free^", "^lottery^",
    "^pills^", "^viagra^", "^cialis^", "^pharmacy^*cheap^", "^cheap^*pharmacy^", "^payday^*loan^", "^payday^*loans^",
    "^adult^", "^porn^", "^xxx^", "^escort^", "^escorts^", "^sex^", "^nude^", "^webcam^*girls^",
    "^spam^", "^seo^*backlinks^", "^link^farm^", "^warez^", "^crack^*serial^", "^torrent^", "^torrents^",
    "^ads^", "^adserver^", "^adclick^", "^banner^*click^", "^track^*click^", "^doubleclick^",
    "^wp^login^", "^cgi^bin^", "^phpmyadmin^", "^captcha^", "@@^responsible^gambling^", "@@^sex^education^")


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lowered), path, and all that follows the host, each empty where the URL has no ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(after, r"\A[^/?#]*", 0), UPPER, UPPER.lower())
    return host, F.regexp_extract(after, r"\A[^/?#]*([^?#]*)", 1), F.regexp_replace(after, r"\A[^/?#]*", "")


def parse_rule(line: str) -> dict:
    """A rule line as a row of ``RULE_SCHEMA``; ValueError where it cannot fit any address."""
    allow = line.startswith("@@")
    body = line[2:] if allow else line
    row = {"line": line, "verdict": "allow" if allow else "block", "kind": "pattern", "rule": body, "host": ""}
    if body.startswith("||"):
        host, slash, path = body[2:].partition("/")
        host = host.translate(str.maketrans(UPPER, UPPER.lower()))
        if not host or re.search(r"[?#]", body):
            raise ValueError(f"a host rule is ||host/path without a query: {line!r}")
        tail = slash + path
        regex = rf"\A(?:[^/?#]*\.)?{re.escape(host)}" + (re.escape(tail) if tail else r"(?=[/?#]|\Z)")
        # a host is whole labels, so its tokens are whole; the last run of the path may go on in the URL
        whole = _lowered(tail)
        whole = re.sub(rf"{TOKEN}\Z", "", whole)
        return row | {"kind": "host", "rule": host + tail, "host": host, "regex": regex,
                      "tokens": _distinct(re.findall(TOKEN, host) + re.findall(TOKEN, whole))}
    first, last = body.startswith("|"), body.endswith("|") and len(body) > 1
    body = _lowered(body[first:len(body) - last])
    if not body.strip("*"):
        raise ValueError(f"a pattern needs text: {line!r}")
    pieces = body.split("*")
    pinned = [first, *[False] * len(pieces)], [*[False] * (len(pieces) - 1), last]
    tokens, regex = [], r"\A"
    for i, piece in enumerate(pieces):
        text = "".join(rf"(?:{EDGE}|\A|\Z)" if c == "^" else re.escape(c) for c in piece)
        gap = "" if pinned[0][i] else ".*?"
        # of several places of a piece the first leaves most room for the rest, so none is tried again
        regex += gap + text + r"\Z" if pinned[1][i] else f"(?>{gap}{text})"
        for m in re.finditer(TOKEN, piece):
            opened = m.start() > 0 or pinned[0][i]
            closed = m.end() < len(piece) or pinned[1][i]
            if opened and closed:
                tokens.append(m.group())
    return row | {"regex": regex, "tokens": _distinct(tokens)}


def _lowered(text: str) -> str:
    return text.translate(str.maketrans(UPPER, UPPER.lower()))


def _distinct(tokens: list[str]) -> list[str]:
    return list(dict.fromkeys(tokens))


def rule_table(spark: SparkSession, lines: Iterable[str]) -> DataFrame:
    """Rule lines as a table; a rule that is listed twice is one rule."""
    rows = [parse_rule(line) for line in dict.fromkeys(lines)]
    names = [c.split()[0] for c in RULE_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], RULE_SCHEMA)


def index_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """``rules`` with ``token``: of a rule's tokens the one that the fewest rows of ``tokens`` (token) equal, ties by
    code points; empty where it has none. Tokens are counted per task first, so a common one is a row per task."""
    held = rules.select("line", F.explode("tokens").alias("token"))
    seen = tokens.groupBy("token").agg(F.count("*").alias("n"))
    rarest = (held.join(seen, "token", "left").groupBy("line")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best")))
    return rules.join(rarest, "line", "left").select(
        *[c for c in rules.columns if c != "tokens"], F.coalesce("best.token", F.lit("")).alias("token"))


@functools.lru_cache(maxsize=4096)
def _compiled(regex: str) -> re.Pattern:
    return re.compile(regex, re.DOTALL)


def fits(rule: dict, host: str, rest: str) -> bool:
    address = host + rest
    return _compiled(rule["regex"]).search(address if rule["kind"] == "host" else _lowered(address)) is not None


def strength(rule: dict) -> tuple:
    """Sorts the rules that fit; the first one counts."""
    if rule["kind"] == "host":
        return 0, -len(rule["rule"]), -len(rule["host"]), rule["verdict"] == "allow", rule["line"]
    return 1, rule["verdict"] == "block", rule["line"]


def judge(host: str, rest: str, index: dict[str, list[dict]]) -> tuple[str | None, str | None, str]:
    """(host rule, pattern, verdict) of one address by the rules that its tokens fetch."""
    best = None
    for token in {"", *re.findall(TOKEN, _lowered(host + rest))}:
        for rule in index.get(token, ()):
            if (best is None or strength(rule) < strength(best)) and fits(rule, host, rest):
                best = rule
    return answer(best)


def answer(best: dict | None) -> tuple[str | None, str | None, str]:
    if best is None:
        return None, None, "allow"
    return (best["rule"], None, best["verdict"]) if best["kind"] == "host" else (None, best["rule"], best["verdict"])


def url_verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule`` (of the host rule that counts), ``pattern`` (of the pattern that
    counts, where no host rule does) and ``verdict`` (``allow`` or ``block``) of every row."""
    host, path, rest = parts(F.col(url_col))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), rest.alias("rest"))
    lowered = F.translate(F.concat("host", "rest"), UPPER, UPPER.lower())
    tokens = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"({TOKEN})")))).alias("token"))
    index = written(index_rules(rules, tokens), "rules")
    size = index.agg(F.sum(sum(F.coalesce(F.octet_length(c), F.lit(0)) + 64 for c in index.columns))).first()[0] or 0
    if size <= max_broadcast:
        return _by_index(urls, index, id_col)
    return _by_join(urls, index, id_col)


_VERDICT = "rule string, pattern string, verdict string"


def _by_index(urls: DataFrame, index: DataFrame, id_col: str) -> DataFrame:
    """Every task looks its URLs' tokens up in the broadcast index."""
    filed: dict[str, list[dict]] = {}
    for r in index.collect():  # at most max_broadcast bytes
        filed.setdefault(r.token, []).append(r.asDict())
    shared = urls.sparkSession.sparkContext.broadcast(filed)
    from pyspark.sql.types import StructType

    target = StructType([f for f in urls.schema if f.name != "rest"] + list(StructType.fromDDL(_VERDICT)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, rules = to_arrow_schema(target), shared.value
        for whole in batches:
            for batch in slices(whole):
                ids, hosts, paths, rests = batch.columns
                judged = [judge(h, r, rules) for h, r in zip(hosts.to_pylist(), rests.to_pylist(), strict=True)]
                made = [pa.array([j[i] for j in judged], pa.string()) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip((ids, hosts, paths, *made), out, strict=True)], schema=out)

    return urls.mapInArrow(run, target)


def _by_join(urls: DataFrame, index: DataFrame, id_col: str) -> DataFrame:
    """Distinct addresses meet the rules by token; the verdicts go back by address.

    The index is a written table and the addresses are distinct, so a common token is a skewed join of two plain
    exchanges, which AQE splits. Candidates are filtered where they arise; a partial minimum per task precedes
    the grouping by address."""
    from pyspark.sql.types import StructType

    lowered = F.translate(F.concat("host", "rest"), UPPER, UPPER.lower())
    distinct = urls.select("host", "rest").distinct()
    found = F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(lowered, F.lit(f"({TOKEN})"))))
    asked = distinct.select("host", "rest", F.explode(found).alias("token"))
    columns = ["line", "kind", "verdict", "rule", "host", "regex"]
    pairs = asked.join(index.select("token", F.struct(*columns).alias("candidate")), "token")
    target = StructType.fromDDL("host string, rest string, place string, rule string, pattern string, verdict string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(target)
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for host, rest, rule in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if fits(rule, host, rest):
                        rows.append((host, rest, sort_text(rule), *answer(rule)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], pa.string()) for i in range(len(out))], schema=out)

    hits = pairs.select("host", "rest", "candidate").mapInArrow(run, target)
    best = hits.groupBy("host", "rest").agg(F.min(F.struct("place", "rule", "pattern", "verdict")).alias("b"))
    best = written(best.select(F.col("host").alias("h"), F.col("rest").alias("r"), "b.rule", "b.pattern", "b.verdict"), "verdicts")
    met = urls.join(best, (F.col("host") == F.col("h")) & (F.col("rest") == F.col("r")), "left")
    return met.select(id_col, "host", "path", "rule", "pattern", F.coalesce("verdict", F.lit("allow")).alias("verdict"))


def sort_text(rule: dict) -> str:
    """``strength`` as text that sorts alike (lengths are below 10^9)."""
    return " ".join(x if isinstance(x, str) else f"{int(x) + (10 ** 9 if not isinstance(x, bool) else 0):010d}" for x in strength(rule))
