"""URL filter: glob rules run together as one bit-parallel automaton over each canonical URL.

All rules are written one behind the other into one long word, a bit for each character (Shift-And).
One step of shifting and masking moves every rule on by a character; `*` and `**` keep their bit set.
Python's integers are the words, so any number of rules fits.

A canonical URL is a dot, the host, a separator and the path. `*` stands for host characters, `**` for
anything. A null url, or one without `://`, has an empty host and path and no rule fits it. Repeated
rows each get their own result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

SEPARATOR = "\0"


@dataclass(frozen=True)
class Rule:
    """A glob over canonical URLs; of the rules that fit, the longest name wins, then the first."""

    glob: str
    name: str
    verdict: str


def host_rule(text: str, verdict: str) -> Rule:
    """A rule like `net/` or `example.com/de/`: the host or a subdomain, and the start of the path."""
    host, _, path = text.partition("/")
    return Rule(f"*.{host}{SEPARATOR}/{path}**", text, verdict)


#: The rules that sites are judged by.
SITE_RULES = (
    host_rule("net/", "block"),
    host_rule("example.net/en/", "allow"),
    host_rule("example.com/de/", "block"),
    host_rule("org/fr/", "allow"),
)
#: What sites without a rule are judged by: telling parts of hosts and paths.
GLOBS = tuple(
    Rule(glob, glob.replace(SEPARATOR, "/"), "block")
    for glob in (
        "*.spam-" + "*" + SEPARATOR + "**",
        "*.cheap-" + "*" + SEPARATOR + "**",
        "*-pills." + "*" + SEPARATOR + "**",
        "*.casino-" + "*" + SEPARATOR + "**",
        "*.casino." + "*" + SEPARATOR + "**",
        "*.xxx." + "*" + SEPARATOR + "**",
        "*" + SEPARATOR + "/wp-login.php**",
        "*" + SEPARATOR + "/cgi-bin/**",
    )
)
DEFAULT = "allow"

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: str | None) -> tuple[str, str]:
    """The host, its A to Z in lower case, and the path without query and fragment."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def automaton(rules: Sequence[Rule]) -> Callable[[str], int]:
    """A function from a canonical URL to a number with a bit set for each rule that fits it."""
    first = 0  # states before any character
    accepts: list[int] = []  # each rule's last state
    moves: dict[str, int] = {}  # states that a character leads into, from the state below
    loops_host = loops_any = 0  # states that stay
    silent = 0  # states of a star, reached without a character from the state below
    at = 0
    for rule in rules:
        first |= 1 << at
        rest = rule.glob
        while rest:
            at += 1
            if rest.startswith("*"):
                any_char = rest.startswith("**")
                silent |= 1 << at
                loops_host |= 0 if any_char else 1 << at
                loops_any |= 1 << at if any_char else 0
                rest = rest[2 if any_char else 1 :]
            else:
                moves[rest[0]] = moves.get(rest[0], 0) | 1 << at
                rest = rest[1:]
        accepts.append(1 << at)
        at += 1

    def closed(state: int) -> int:
        # two stars never stand side by side
        return state | (state << 1) & silent

    start = closed(first)

    def run(text: str) -> int:
        state = start
        for ch in text:
            loops = loops_any if ch == SEPARATOR else loops_any | loops_host
            state = closed((state << 1) & moves.get(ch, 0) | state & loops)
            if not state:
                return 0
        return sum(1 << k for k, bit in enumerate(accepts) if state & bit)

    return run


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = SITE_RULES,
    globs: Sequence[Rule] = GLOBS,
    url_col: str = "url",
    key_col: str = "page_id",
) -> DataFrame:
    """One row for each page: key, host, path, rule, verdict, glob.

    `rule` is the name of the longest of `rules` that fits, `verdict` its verdict; without one, the
    verdict of the longest of `globs` (named in `glob`), and else DEFAULT.
    """
    both = [*rules, *globs]
    n = len(rules)

    def best(hits: int, which: range) -> Rule | None:
        fit = [both[k] for k in which if hits >> k & 1]
        return max(fit, key=lambda r: len(r.name), default=None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        match = automaton(both)
        for batch in batches:
            rows = []
            for url in batch["url"]:
                host, path = host_and_path(url)
                hits = match("." + host.replace(SEPARATOR, "\1") + SEPARATOR + path)
                site, glob = best(hits, range(n)), best(hits, range(n, len(both)))
                chosen = site or glob
                rows.append(
                    (
                        host,
                        path,
                        site and site.name,
                        chosen.verdict if chosen else DEFAULT,
                        glob.name if glob and not site else None,
                    )
                )
            out = pd.DataFrame(rows, columns=["host", "path", "rule", "verdict", "glob"])
            out.insert(0, "key", batch["key"].to_numpy())
            yield out

    kind = pages.schema[key_col].dataType.simpleString()
    urls = pages.selectExpr(f"`{key_col}` AS key", f"`{url_col}` AS url")
    judged = urls.mapInPandas(
        run, f"key {kind}, host string, path string, rule string, verdict string, glob string"
    )
    return judged.withColumnRenamed("key", key_col)
