"""Names, ids, canonical forms, parsers and classifications of text."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed from names, characters that become spaces, and generational suffixes.
REMOVED = "'’ʼ`´"
SPACED = ".,-/\\_()[]{}:;|–—‐‑+*\""
SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")


#: Syllables of Hangul are made of parts by rule: so many first, middle and last ones (the first of these being none).
HANGUL, FIRSTS, MIDDLES, LASTS = 0xAC00, 19, 21, 28
#: White space that no decomposition turns into a plain space, beside ASCII.
SPACE = "[\\s\\x1c-\\x1f\\x85\\u1680\\u2028\\u2029]+"


def _plain(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


def _ranges(codes: Sequence[int]) -> str:
    """A character class of the ascending codes."""
    out, start, last = "", None, None
    for code in [*codes, None]:
        if start is not None and code != last + 1:
            out += f"\\x{{{start:x}}}-\\x{{{last:x}}}"
            start = None
        start, last = code if start is None else start, code
    return f"[{out}]"


@cache
def _decompositions() -> tuple[str, str, tuple[str, ...], tuple[str, ...], str]:
    """From the compatibility decomposition of every character, without combining marks: those that become one other
    character and what they become, with those that vanish behind them; those that become several, and these; their class."""
    single, vanish, many = {}, [], {}
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x110000)):
        c = chr(code)
        if HANGUL <= code < HANGUL + FIRSTS * MIDDLES * LASTS or not (unicodedata.decomposition(c) or unicodedata.combining(c)):
            continue
        plain = _plain(c)
        if not plain:
            vanish.append(c)
        elif len(plain) > 1:
            many[c] = plain
        elif plain != c:
            single[c] = plain
    codes = sorted([*map(ord, many), *range(HANGUL, HANGUL + FIRSTS * MIDDLES * LASTS)])
    return "".join(single) + "".join(vanish), "".join(single.values()), tuple(many), tuple(many.values()), _ranges(codes)


@cache
def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """Lower-case characters without accents whose case folding is another character, or several."""
    one, more = {}, {}
    for code in (*range(0x80, 0xAC00), *range(0x10000, 0x20000)):
        for low in {x for c in _plain(chr(code)) for x in c.lower()}:
            folded = low.casefold()
            if folded != low:
                (one if len(folded) == 1 else more)[low] = folded
    return one, more


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip_accents(text: Column) -> Column:
    """Compatibility decomposition without combining marks: accents go, ligatures and wide letters become plain ones.

    Characters that become one are a translation; only texts with others, Hangul or ligatures and the like, are taken
    apart by character.
    """
    single, plain, many, values, class_ = _decompositions()
    held, keys = F.split(F.lit("\0".join(values)), "\0"), F.lit("".join(many))
    parts = [F.array(*[F.lit(chr(first + k) if k or first != 0x11A7 else "") for k in range(n)]) for first, n in ((0x1100, FIRSTS), (0x1161, MIDDLES), (0x11A7, LASTS))]

    def apart(c: Column) -> Column:
        n, at = F.ascii(c) - HANGUL, F.call_function("instr", keys, c)
        places = (F.floor(n / (MIDDLES * LASTS)), F.floor(n % (MIDDLES * LASTS) / LASTS), n % LASTS)
        syllable = F.concat(*[F.element_at(p, (k + 1).cast("int")) for p, k in zip(parts, places, strict=True)])
        return F.when((n >= 0) & (n < FIRSTS * MIDDLES * LASTS), syllable).when(at > 0, F.element_at(held, at)).otherwise(c)

    several = lambda t: F.when(t.rlike(class_), F.array_join(F.transform(F.split(t, ""), apart), "")).otherwise(t)
    return _once(F.translate(text, single, plain), several)


def case_fold(text: Column) -> Column:
    """Full case folding of a text without accents."""
    one, more = _folds()
    folded = F.translate(F.lower(text), "".join(one), "".join(one.values()))
    for low, several in more.items():
        folded = F.replace(folded, F.lit(low), F.lit(several))
    return folded


def name_tokens(text: Column) -> Column:
    plain = F.replace(case_fold(strip_accents(text)), F.lit("&"), F.lit(" and "))
    folded = F.translate(F.translate(plain, SPACED, " " * len(SPACED)), REMOVED, "")
    return F.filter(F.split(folded, SPACE), lambda t: t != "")


def _suffix(tokens: Column) -> Column:
    last = F.try_element_at(tokens, F.lit(-1))
    return F.when((F.size(tokens) > 1) & last.isin(*SUFFIXES), last).otherwise("")


def name_suffix(text: Column) -> Column:
    return _once(name_tokens(text), _suffix)


def normalized_name(text: Column) -> Column:
    """Plain lower-case name without its generational suffix; a name of single letters only is one word."""

    def join(kept: Column) -> Column:
        initials = (F.size(kept) > 1) & F.forall(kept, lambda x: F.length(x) == 1)
        return F.when(initials, F.array_join(kept, "")).otherwise(F.array_join(kept, " "))

    drop = lambda t: F.when(_suffix(t) != "", F.slice(t, F.lit(1), F.greatest(F.size(t) - 1, F.lit(0)))).otherwise(t)
    return _once(_once(name_tokens(text), drop), join)


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def canonical_json(columns: Sequence[str]) -> Column:
    """JSON of the columns in the order of their names, nulls kept: equal rows give equal text."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def content_hash(columns: Sequence[str]) -> Column:
    return F.sha2(canonical_json(columns), 256)


def subject_pattern(subject: str) -> str:
    """Regular expression of a subject with ``*`` for one token and ``>`` for the rest."""
    out = ""
    for i, token in enumerate(subject.split(".")):
        if token == ">":
            return f"^{out}(\\..*)?$" if i else "^.*$"
        out += ("\\." if i else "") + ("[^.]+" if token == "*" else "".join("\\" + c if not c.isalnum() else c for c in token))
    return f"^{out}$"


def redact(text: Column) -> Column:
    """Values of credentials in URLs, headers and parameters are replaced."""
    url = F.regexp_replace(text, r"(?i)([?&](?:api_?key|token|access_token|secret|signature)=)[^&\s]+", "$1[REDACTED]")
    return F.regexp_replace(url, r"(?i)\b(authorization|x-api-key|bearer)(\s*[:=]?\s*)(?:bearer\s+)?[A-Za-z0-9._~+/-]{8,}=*", "$1$2[REDACTED]")


def http_class(status: Column) -> Column:
    return (
        F.when(status.isNull(), "no_response").when(status.between(200, 299), "available").when(status.isin(401, 403), "not_entitled").when(status.isin(404, 410), "not_found")
        .when(status == 429, "rate_limited").when(status.between(500, 599), "server_error").otherwise("unexpected")
    )


def ticker_date(ticker: Column) -> Column:
    """Date code ``YYMONDD`` after the series, as a date."""
    code = F.regexp_extract(ticker, r"^[A-Z0-9]+-(\d{2}[A-Z]{3}\d{2})", 1)
    return F.try_to_date(F.concat(F.lit("20"), F.substring(code, 1, 2), F.initcap(F.substring(code, 3, 3)), F.substring(code, 6, 2)), "yyyyMMMdd")


def unique_split(code: Column, known: Sequence[str]) -> Column:
    """(first, second) of a code of two joined members of ``known``; null unless exactly one split fits."""
    known_ = F.array(*[F.lit(k) for k in known])
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.length(code) - 1, F.lit(1))), lambda i: F.array_contains(known_, F.substr(code, F.lit(1), i)) & F.array_contains(known_, F.substr(code, i + 1)))
    return F.when(F.size(at) == 1, F.struct(F.substr(code, F.lit(1), at[0]).alias("first"), F.substr(code, at[0] + 1).alias("second")))


def title_teams(title: Column) -> Column:
    """(away, home) of ``A at B`` or, with sides unknown, of ``A vs B``."""
    pattern = r"(?i)^(.+?)\s+(at|vs\.?|@)\s+(.+?)(?:\s+winner\?)?$"
    return F.when(title.rlike(pattern), F.struct(F.regexp_extract(title, pattern, 1).alias("first"), F.lower(F.regexp_extract(title, pattern, 2)).alias("link"), F.regexp_extract(title, pattern, 3).alias("second")))


def lookup(value: Column, table: dict[str, object], default=None) -> Column:
    """A literal table as nested choices."""
    out = None
    for k, v in table.items():
        out = F.when(value == k, F.lit(v)) if out is None else out.when(value == k, F.lit(v))
    return out.otherwise(F.lit(default))


def ticker_parts(ticker: Column) -> Column:
    """(series, date, clock, teams, suffix) of ``SERIES-YYMONDD[HHMM]TEAMS[-SUFFIX]``; null where it is none."""
    pattern = r"^([A-Z0-9]+)-(\d{2}[A-Z]{3}\d{2})(\d{4})?([A-Z]+)(?:-([A-Z0-9.]+))?$"
    part = lambda n: F.nullif(F.regexp_extract(ticker, pattern, n), F.lit(""))
    clock = F.concat_ws(":", F.substring(part(3), 1, 2), F.substring(part(3), 3, 2))
    return F.when(ticker.rlike(pattern), F.struct(part(1).alias("series"), ticker_date(ticker).alias("date"), F.when(part(3).isNotNull(), clock).alias("clock"), part(4).alias("teams"), part(5).alias("suffix")))


def rules_text(text: Column) -> Column:
    """(team, opponent, day, clock, zone) that a market's rules name; null parts where they are silent."""
    names = r"(?i)if (?:the )?(.+?) wins? .*?(?:against|versus|vs\.?) (?:the )?(.+?) (?:game|scheduled|originally|on )"
    day, clock = r"(?i)\b((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]* \d{1,2}, \d{4})", r"(?i)\b(\d{1,2}:\d{2} ?[AP]M) ?([A-Z]{2,4})?"
    get = lambda p, n: F.nullif(F.regexp_extract(text, p, n), F.lit(""))
    return F.struct(get(names, 1).alias("team"), get(names, 2).alias("opponent"), get(day, 1).alias("day"), F.upper(get(clock, 1)).alias("clock"), get(clock, 2).alias("zone"))


def bound_alias(name: Column, suffix: Column, held: Column, held_suffix: Column) -> Column:
    """Whether an alias is a name's: equal, and with the same suffix where either side states one."""
    return (name == held) & (F.coalesce(suffix, F.lit("")) == F.coalesce(held_suffix, F.lit("")))


def period_scores(text: Column) -> Column:
    """(period, home, away) rows of a JSON map of periods, overtime keys as they come, in order of the key."""
    entries = F.map_entries(F.from_json(text, "map<string,struct<home:long,away:long>>"))
    return F.array_sort(F.transform(entries, lambda e: F.struct(e["key"].alias("period"), e["value"]["home"].alias("home"), e["value"]["away"].alias("away"))))
