"""Allow and block rules for URLs, held in a trie over host labels and path segments."""

from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """A verdict for ``host``, all its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"


def rule(verdict: str, text: str) -> Rule:
    """``block example.com/en/`` as a Rule."""
    host, slash, path = text.partition("/")
    return Rule(verdict, host.translate(str.maketrans(UPPER, LOWER)), slash + path)


class UrlTrie:
    """Labels from the top level down, then whole path segments, then a segment's beginning.

    A node is [children by label, root of its paths or None]; a path node is
    [children by segment, {beginning of the next segment: rule}].
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root = [{}, None]
        for r in sorted(set(rules)):  # allow before block: of the same rule, block stays
            if r.verdict not in ("allow", "block"):
                raise ValueError(f"a rule allows or blocks, not {r.verdict}")
            node = self.root
            for label in reversed(r.host.split(".")) if r.host else ():
                node = node[0].setdefault(label, [{}, None])
            if node[1] is None:
                node[1] = [{}, {}]
            node = node[1]
            *closed, beginning = r.path.split("/")
            for segment in closed:
                node = node[0].setdefault(segment, [{}, {}])
            node[1][beginning] = (r.host + r.path, r.verdict)

    @classmethod
    def of(cls, root: list) -> "UrlTrie":
        trie = cls(())
        trie.root = root
        return trie

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest rule that fits, as (rule, verdict): most characters, then most host."""
        best, segments = None, None
        node = self.root
        labels = host.split(".") if host else []
        while node is not None:
            if node[1] is not None:
                segments = segments or path.split("/")
                at = node[1]
                for segment in segments:
                    for n in range(len(segment) + 1) if at[1] else ():
                        found = at[1].get(segment[:n])
                        if found and (best is None or len(found[0]) >= len(best[0])):
                            best = found
                    at = at[0].get(segment)
                    if at is None:
                        break
            node = node[0].get(labels.pop()) if labels else None
        return best


def url_parts(url):
    """Columns host and path: host is between the first ``://`` and ``/``, ``?`` or ``#``."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring_index(F.substring_index(F.expr("substr(url, instr(url, '://') + 3)"), "?", 1), "#", 1)
    host = F.translate(F.substring_index(rest, "/", 1), UPPER, LOWER)
    path = F.substring(rest, F.length(F.substring_index(rest, "/", 1)) + 1, 1 << 30)
    return F.when(has, host).otherwise("").alias("host"), F.when(has, path).otherwise("").alias("path")


def judge_urls(
    pages: DataFrame,
    rules: Iterable[Rule],
    default: str = "allow",
    id_column: str = "page_id",
    url_column: str = "url",
    most_rules: int = 200_000,
) -> DataFrame:
    """Host, path, longest rule and verdict of every URL; ``default`` where no rule fits.

    The trie is broadcast; ``most_rules`` bounds it (some 100 MB), and a longer list
    raises, because it belongs in a table that is joined. A null URL or one without
    ``://`` has an empty host and path. Empty paths fit no rule, as a rule's path
    begins with ``/``. Of rules that differ in the verdict only, block wins.
    Repeated rows are judged each; columns besides id and URL are not read, so
    clashing names do no harm; an empty table gives no rows.
    """
    rules = list(rules)
    if len(rules) > most_rules:
        raise ValueError(f"{len(rules)} rules; at most {most_rules} are broadcast")
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules).root)

    @pandas_udf("rule string, verdict string")
    def find(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        search, none = UrlTrie.of(trie.value).find, (None, default)
        return pd.DataFrame([search(h, p) or none for h, p in zip(host, path)], columns=["rule", "verdict"])

    parts = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"))
    parts = parts.select("page_id", *url_parts(F.col("url")))
    return parts.withColumn("found", find("host", "path")).select("page_id", "host", "path", "found.*")
