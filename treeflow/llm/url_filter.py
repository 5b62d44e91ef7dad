"""URL filters: host and path rules, then a weighted URL vocabulary.

One Aho-Corasick automaton over all terms reads each lower-cased URL once.  A term counts
only between boundaries, that is where no ASCII letter or digit adjoins it.  One strict term
or `soft_limit` different soft terms block the page.  Rules go first: a rule fits its host
and all subdomains where the path starts with the rule's, and the longest one decides.
They are looked up by the host's own suffixes, so many rules cost no more than few.
"""

from __future__ import annotations

from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._spark import ship

# Terms that mark a URL as unwanted by themselves, and terms that do so together.
# Words that clean URLs hold as well (win, free, cheap, adult, pharmacy, spam) are soft.
STRICT = (
    # adult
    "porn", "porno", "pornos", "pornstar", "pornstars", "xxx", "x-rated", "hentai", "camgirl", "camgirls", "camsex", "sexcam", "sexcams", "livesex", "sexchat", "xvideos", "milf", "milfs", "blowjob", "blowjobs", "gangbang", "gangbangs", "nsfw", "upskirt", "callgirl", "callgirls",
    # gambling
    "casino", "casinos", "sportsbook", "sportsbooks", "sportsbet", "freespins", "freebet", "freebets",
    # pharmacy
    "viagra", "cialis", "levitra", "kamagra",
    # pirated goods and advertising
    "warez", "keygen", "keygens", "adserver", "adservers", "adclick", "popunder", "popunders",
)
SOFT = (
    # adult
    "sex", "sexy", "nude", "nudes", "naked", "adult", "adults", "escort", "escorts", "erotic", "erotica", "fetish", "fetishes", "webcam", "webcams", "hookup", "hookups", "dating",
    # gambling
    "poker", "roulette", "blackjack", "baccarat", "bookmaker", "bookmakers", "bookie", "bookies", "bet", "bets", "betting", "gamble", "gambling", "gambler", "gamblers", "wager", "wagers", "wagering", "slots", "jackpot", "jackpots", "lotto", "lottery", "lotteries", "bingo", "odds", "spins",
    # pharmacy
    "pill", "pills", "pharmacy", "pharmacies", "pharma", "drugs", "drugstore", "meds", "rx", "steroid", "steroids", "sildenafil", "tadalafil", "phentermine", "tramadol", "xanax", "valium", "ambien",
    # spam, advertising, pirated goods
    "spam", "spams", "spammer", "spammers", "spammy", "ads", "adverts", "banners", "popup", "popups", "linkfarm", "linkfarms", "backlink", "backlinks", "torrent", "torrents", "crack", "cracks", "cracked", "nulled", "payday", "replica", "replicas",
    # supporting words
    "win", "wins", "winner", "winners", "winning", "free", "cheap", "cheapest", "bonus", "bonuses", "prize", "prizes",
)
SOFT_LIMIT = 2
MAX_TERMS = 1_000_000
#: (rule, verdict); a rule is a host, then its path from the first slash
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))

_LOWER = {c: c + 32 for c in range(65, 91)}
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ://."""
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((p for p in map(rest.find, "?#") if p >= 0), default=len(rest))
    slash = rest.find("/", 0, end)
    return (rest[:end], "") if slash < 0 else (rest[:slash], rest[slash:end])


def _by_host(rules) -> dict[str, list[tuple[str, str, str]]]:
    out: dict[str, list[tuple[str, str, str]]] = {}
    for rule, verdict in rules:
        host, slash, path = rule.partition("/")
        out.setdefault(host.translate(_LOWER), []).append((slash + path, rule, verdict))
    return out


def fitting_rule(by_host, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule that fits and its verdict; of rules of one length the longer host's."""
    best = None
    while host:
        for start, rule, verdict in by_host.get(host, ()):
            if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                best = (rule, verdict)
        host = host.partition(".")[2]
    return best


def read_terms(table: DataFrame, term_col: str = "term", kind_col: str = "kind", most: int = MAX_TERMS) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(strict, soft) terms of a table with a row for each: its term, and `strict` or `soft`.

    A term that is given as both is strict; null and empty terms are left out, and another kind
    is an error.  The terms go to every task, so a table of more than `most` is an error too."""
    rows = table.select(F.translate(term_col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("term"), F.col(kind_col).alias("kind")).filter("term <> ''").distinct()
    if rows.count() > most:
        raise ValueError(f"more than {most} terms")
    by = {"strict": set(), "soft": set()}
    for r in rows.collect():
        if r.kind not in by:
            raise ValueError(f"unknown kind of term: {r.kind}")
        by[r.kind].add(r.term)
    return tuple(sorted(by["strict"])), tuple(sorted(by["soft"] - by["strict"]))


@cache
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for t in terms:
            a.add_word(t.translate(_LOWER), (kind, t.translate(_LOWER)))
    if len(a):
        a.make_automaton()
    return a


def terms_in(automaton, url: str | None) -> tuple[int, set[str]]:
    """Strict occurrences and the different soft terms of a URL."""
    strict, soft = 0, set()
    if not url or not len(automaton):
        return strict, soft
    low = url.translate(_LOWER)
    for last, (kind, term) in automaton.iter(low):
        first = last - len(term)
        if (first < 0 or low[first] not in _ALNUM) and (last + 1 == len(low) or low[last + 1] not in _ALNUM):
            if kind == "strict":
                strict += 1
            else:
                soft.add(term)
    return strict, soft


def judge_urls(pages: DataFrame, id_col="page_id", url_col="url", rules=RULES, strict=STRICT, soft=SOFT, soft_limit=SOFT_LIMIT) -> DataFrame:
    """id_col, host, path, rule (null if none fits), verdict, n_strict, n_soft.

    A null URL, or one without ://, has an empty host and path; no rule fits it, and its
    terms decide (a null has none: allow).  Each row is judged by itself, so repeated rows
    and ids give equal rows; other columns are ignored and no rows give no rows.
    """
    ship(pages.sparkSession)
    strict, soft = tuple(strict), tuple(soft)
    by_host = _by_host(rules)

    def run(batches):
        automaton = _automaton(strict, soft)
        for batch in batches:
            rows = []
            for url in T.column(batch, url_col).to_pylist():
                host, path = split_url(url)
                host = host.translate(_LOWER)
                n_strict, softs = terms_in(automaton, url)
                rule = fitting_rule(by_host, host, path)
                own = "block" if n_strict or len(softs) >= soft_limit else "allow"
                rows.append((host, path, rule[0] if rule else None, rule[1] if rule else own, n_strict, len(softs)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            made = [pa.array(c, t) for c, t in zip(cols, [pa.string()] * 4 + [pa.int64()] * 2, strict=True)]
            yield pa.RecordBatch.from_arrays([T.column(batch, id_col), *made], [id_col, "host", "path", "rule", "verdict", "n_strict", "n_soft"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, url_col).mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string, n_strict long, n_soft long")
