"""URL filter: a weighted vocabulary, found by one Aho-Corasick automaton, behind rules on hosts and paths.

A url is scanned once in lower case. An occurrence of a term counts where no letter or digit stands before or behind it;
each distinct term adds its weight, and a url whose weights reach ``LEAST`` is blocked: one strict term, or several
distinct soft ones. A rule that fits the url's host and path goes before the vocabulary.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import map_rows

#: A url is blocked when the weights of its distinct terms reach this.
LEAST = 2
# Words that name adult, gambling or piracy sites by themselves, and words that do so only together.
STRICT = ("porn", "porno", "pornhub", "xvideos", "xhamster", "xnxx", "xxx", "hentai", "redtube", "youporn", "camgirls", "sexcam", "sexcams",
          "milf", "milfs", "nsfw", "escorts", "casino", "casinos", "torrent", "torrents", "warez", "keygen")
SOFT = ("adult", "adults", "amateur", "babes", "bet", "betting", "bonus", "cam", "cams", "cheap", "crack", "cracked", "dating", "erotic", "escort",
        "free", "fetish", "girls", "gambling", "hot", "jackpot", "live", "loan", "loans", "naked", "nude", "nudes", "pills", "poker", "roulette",
        "serial", "sex", "sexy", "slots", "teen", "teens", "tube", "viagra", "webcam")
TERMS = {**dict.fromkeys(SOFT, 1), **dict.fromkeys(STRICT, LEAST)}
#: Characters of rules and terms together: they are sent to every task and held there.
LIST_CHARS = 8 << 20

# After A-Z is lower-cased, other ASCII than letters and digits ends a word; so does an escaped character.
_EDGE = frozenset(map(chr, (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))))
_LOWER = {b: b + 32 for b in range(65, 91)}
_ESCAPE = re.compile("%[0-9A-Fa-f]{2}")
_AFTER = re.compile(r"([^/?#]*)([^?#]*)")
_built: dict = {}


def split(url: str | None) -> tuple[str, str]:
    """(host, path): the host in lower case; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    host, path = _AFTER.match(rest).groups()
    return (host.translate(_LOWER), path) if mark else ("", "")


def automaton(terms: dict[str, int]):
    import ahocorasick

    out = ahocorasick.Automaton()
    for term in terms:
        if term:
            out.add_word(term, term)
    if len(out):
        out.make_automaton()
    return out


def found(machine, url: str | None) -> list[str]:
    """Distinct terms of the vocabulary in the url, in order of their first ends."""
    if url is None or not len(machine):
        return []
    text = f" {_ESCAPE.sub(' ', url).translate(_LOWER)} "
    return list(dict.fromkeys(term for end, term in machine.iter(text)
                              if text[end + 1] in _EDGE and text[end - len(term)] in _EDGE))


def by_host(rules) -> dict[str, list[tuple[str, str]]]:
    """{host: its (path, verdict), longest path first; of equal paths block before allow}."""
    out: dict[str, list[tuple[str, str]]] = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"no such verdict: {verdict}")
        out.setdefault(host.translate(_LOWER), []).append((path, verdict))
    return {host: sorted(own, key=lambda x: (-len(x[0]), x[1] != "block")) for host, own in out.items()}


def fitting(rules: dict[str, list[tuple[str, str]]], host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule of the host or a domain above it whose path begins the url's."""
    best, size, domain = None, -1, host
    while domain:  # from the host upward: of equally long rules the one of the longer host stays
        for start, verdict in rules.get(domain, ()):
            if path.startswith(start):
                if len(domain) + len(start) > size:
                    best, size = (domain + start, verdict), len(domain) + len(start)
                break
        domain = domain.partition(".")[2]
    return best


def judge(pages: DataFrame, *, rules=(), terms: dict[str, int] | None = None, least: int = LEAST, key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, weight and terms.

    ``rules`` are (allow or block, host, path). A rule fits its host and all subdomains where the url's path begins with the
    rule's; the longest in characters wins, then the longer host, then block. Without a fitting rule the verdict is the vocabulary's:
    ``terms`` maps lower-case words to weights, ``weight`` sums those of the distinct words found. Every url is judged alone:
    a null url has no host, path and terms and is allowed, an empty or very long one is judged like any other, rows that
    repeat stay. Without terms nothing but rules blocks. Other columns are not read, whatever their names.
    Rules and terms go to every task, so together they may have ``LIST_CHARS`` characters; more is an error.
    """
    given = (tuple(rules), tuple(sorted((TERMS if terms is None else terms).items())))
    if sum(len(host) + len(path) for _, host, path in given[0]) + sum(len(term) for term, _ in given[1]) > LIST_CHARS:
        raise ValueError(f"rules and terms have more than {LIST_CHARS} characters")
    shared = pages.sparkSession.sparkContext.broadcast((hashlib.sha256(repr(given).encode()).hexdigest(), *given))
    kind = dict(pages.dtypes)[key]

    def make():
        digest, listed, words = shared.value
        if digest not in _built:
            _built.clear()
            _built[digest] = by_host(listed), automaton(dict(words))
        (own, machine), weights = _built[digest], dict(words)

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("host", "path", "rule", "verdict", "weight", "terms")}
            for address in batch.column("url").to_pylist():
                host, path = split(address)
                hits = found(machine, address)
                weight = sum(weights[x] for x in hits)
                rule, verdict = fitting(own, host, path) or (None, "block" if weight >= least else "allow")
                for name, value in (("host", host), ("path", path), ("rule", rule), ("verdict", verdict), ("weight", weight), ("terms", hits)):
                    out[name].append(value)
            return out | {"page_id": batch.column("page_id")}

        return work

    rows = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"))
    return map_rows(rows, f"page_id {kind}, host string, path string, rule string, verdict string, weight bigint, terms array<string>", make)
