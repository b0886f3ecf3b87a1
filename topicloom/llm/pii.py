"""Operator 6: format-preserving Feistel pseudonyms (DataFrame only).

Numbers that pass their own validation (payment cards by check digit, phone and
social-security numbers by shape, IPv4 addresses by octet range) and calendar dates
are replaced by a keyed permutation of the values of their format: a balanced or
alternating Feistel network over digit halves, 16-bit halves, or day numbers.  A
permutation keeps distinct values distinct and equal values equal, in every document.
Card numbers keep a valid check digit; separators stay.  A card may stand next to other
numbers: every run of whole digit groups is tried (a tenth of all such runs of other
numbers pass the check too, and are replaced).  Dates with '/' are read as dd/MM, or as
MM/dd where that is no date; the latter are permuted among themselves.  E-mail names and access
secrets have no number format; they get keyed tokens of their shape.

One pass, no shuffle: a text is split at its matches and joined with the pseudonyms.
The key is a parameter; ``DEMO_KEY`` is for tests and the registered query.

Defined results: a null text stays null with nothing found; matches that fail
validation stay; dates outside the permuted days (1900-01-01 and 72,899 days on)
stay; other columns pass through, except ``n_found``, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEMO_KEY = "not-a-secret"
ROUNDS = 8
EPOCH, SIDE = "1900-01-01", 270

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
PHONE = (
    r"(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![0-9.-])(?:\+?[0-9]{1,3}[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
DAY_DATE = r"(?<![0-9./])[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9])"
SECRET = r"AKIA[0-9A-Z]{16}|password=[^\s\"']+|(?<![0-9A-Za-z])[0-9a-f]{40}(?![0-9A-Za-z])"

#: Groups of digits, 13 digits or more, up to a value of another kind; cards are sub-runs of whole groups.
OTHERS = "|".join([EMAIL, SECRET, ISO_DATE, DAY_DATE, SSN, PHONE, IPV4])
GROUPS = r"(?<![0-9.-])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?:[ -](?!" + OTHERS + r")[0-9]++)*+"
ANY = "|".join([EMAIL, SECRET, ISO_DATE, DAY_DATE, SSN, PHONE, GROUPS, IPV4])
#: Digits in the groups of a card as they are usually written.
USUAL = r"^(1[3-9]|4-4-4-4|4-4-4-4-3|4-6-5|4-6-4)$"
#: Days moved on, at most, until one is found that can't be read as dd/MM.
WALK = 64


def _q(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _round(key: str, kind: str, tweak: str, r: str, value: str) -> str:
    """60 bits of a keyed hash of a half, as a long."""
    return f"cast(conv(substr(sha2(concat_ws('|', {_q(key)}, '{kind}', {tweak}, {r}, {value}), 256), 1, 15), 16, 10) as bigint)"


def _power(digits: str) -> str:
    return f"cast(rpad('1', 1 + {digits}, '0') as bigint)"


def digits_feistel(key: str, kind: str, d: str) -> str:
    """SQL: the digit string ``d`` (2 to 36 digits), permuted among those of its length."""
    n, u = f"length({d})", f"(length({d}) div 2)"
    v = f"({n} - {u})"
    return (
        f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('a', cast(substr({d}, 1, {u}) as bigint), 'b', cast(substr({d}, 1 + {u}) as bigint)), "
        f"(s, r) -> named_struct('a', s.b, 'b', pmod(s.a + pmod({_round(key, kind, n, 'r', 's.b')}, {_power(f'if(r % 2 = 0, {u}, {v})')}), {_power(f'if(r % 2 = 0, {u}, {v})')})), "
        f"s -> concat(lpad(cast(s.a as string), {u}, '0'), lpad(cast(s.b as string), {v}, '0')))"
    )


def pair_feistel(key: str, kind: str, a: str, b: str, side: int, out: str) -> str:
    """SQL: the pair (a, b) of numbers below ``side``, permuted; ``out`` is an expression of s.a and s.b."""
    return (
        f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)), "
        f"(s, r) -> named_struct('a', s.b, 'b', pmod(s.a + pmod({_round(key, kind, str(side), 'r', 's.b')}, {side}L), {side}L)), s -> {out})"
    )


def luhn_sum(d: str, first_doubled: str) -> str:
    """SQL: Luhn sum of the digit string; positions of the given parity from the right (0: the last) count twice."""
    digit = f"cast(substr({d}, i, 1) as int)"
    return (
        f"aggregate(sequence(1, length({d})), 0, (t, i) -> t + if((length({d}) - i) % 2 = {first_doubled}, "
        f"if({digit} > 4, 2 * {digit} - 9, 2 * {digit}), {digit}))"
    )


def refill(m: str, d: str) -> str:
    """SQL: the match with its digits replaced, in order, by those of ``d``."""
    return (
        f"aggregate(sequence(1, length({m})), named_struct('o', '', 'k', 1, 'd', {d}), (s, i) -> "
        f"if(substr({m}, i, 1) between '0' and '9', named_struct('o', concat(s.o, substr(s.d, s.k, 1)), 'k', s.k + 1, 'd', s.d), "
        f"named_struct('o', concat(s.o, substr({m}, i, 1)), 'k', s.k, 'd', s.d)), s -> s.o)"
    )


def cards_sql(key: str, m: str) -> str:
    """SQL: struct (o, n): groups of digits with the cards in them replaced, and their number.

    Every sub-run of whole groups with 13 to 19 digits is tried against its check digit.
    From the left, a card in usual groups goes first, then the longest sub-run that takes
    no group of such a card."""
    part = "array_join(slice(p, i, j - i + 1), '')"
    digits = lambda x: f"regexp_replace({x}, '[^0-9]', '')"
    valid = f"transform(array({digits(part)}), d -> length(d) between 13 and 19 and {luhn_sum('d', '1')} % 10 = 0)[0]"
    usual = f"array_join(transform(slice(p, i, j - i + 1), x -> cast(length({digits('x')}) as string)), '-') rlike '{USUAL}'"
    body = "substr(d, 1, length(d) - 1)"
    card = f"transform(array({digits_feistel(key, 'card', body)}), x -> concat(x, cast((10 - {luhn_sum('x', '0')} % 10) % 10 as string)))[0]"
    new = f"transform(array({part}), c -> transform(array({digits('c')}), d -> {refill('c', card)})[0])[0]"
    ends = f"transform(sequence(1, size(p)), i -> filter(sequence(i, least(i + 18, size(p))), j -> {valid}))"
    first = f"transform(sequence(1, size(p)), i -> array_min(filter(e[i - 1], j -> {usual})))"
    chosen = "transform(sequence(1, size(p)), i -> coalesce(u[i - 1], array_max(filter(e[i - 1], j -> not exists(slice(u, i + 1, j - i), x -> x is not null)))))"
    walk = (
        "aggregate(sequence(1, size(p)), named_struct('o', '', 'at', 1, 'n', 0), (s, i) -> if(i < s.at or f[i - 1] is null, s, "
        f"transform(array(f[i - 1]), j -> transform(array({new}), x -> named_struct('o', concat(s.o, array_join(slice(p, s.at, i - s.at), ''), x), "
        f"'at', j + 1, 'n', s.n + if(x = {part}, 0, 1)))[0])[0]), s -> named_struct('o', concat(s.o, array_join(slice(p, s.at, size(p)), '')), 'n', s.n))"
    )
    bind = lambda name, value, then: f"transform(array({value}), {name} -> {then})[0]"
    return bind("p", f"regexp_extract_all({m}, '[ -]?[0-9]+', 0)", bind("e", ends, bind("u", first, bind("f", chosen, walk))))


def pseudonym_sql(key: str, m: str = "m") -> str:
    """SQL: struct (o, n): the pseudonym of a match ``m``, or ``m`` where it doesn't pass
    validation, and the number of values replaced."""
    d = f"regexp_replace({m}, '[^0-9]', '')"
    full = lambda p: f"{m} rlike {_q('^(?:' + p + ')$')}"
    sha = f"sha2(concat_ws('|', {_q(key)}, 'token', {m}), 256)"
    octets = f"transform(split({m}, '[.]'), x -> cast(x as bigint))"
    dotted = "concat_ws('.', s.a div 256, s.a % 256, s.b div 256, s.b % 256)"
    ip = f"transform(array({octets}), o -> {pair_feistel(key, 'ipv4', 'o[0] * 256 + o[1]', 'o[2] * 256 + o[3]', 65536, dotted)})[0]"

    def date(form: str, other: str = "") -> str:
        """Days by ``form``; those that only ``other`` can read are permuted among themselves."""
        day = lambda f: f"datediff(cast(try_to_timestamp({m}, '{f}') as date), date'{EPOCH}')"
        step = lambda n, out: pair_feistel(key, "date", f"{n} div {SIDE}", f"{n} % {SIDE}", SIDE, out)
        n, on = f"cast(s.a * {SIDE} + s.b as int)", lambda x: f"date_add(date'{EPOCH}', {x})"
        moved = step("n", f"date_format({on(n)}, '{form}')")
        got = f"transform(array({day(form)}), n -> if(n between 0 and {SIDE * SIDE - 1}, {moved}, {m}))[0]"
        if not other:
            return got
        walked = f"aggregate(sequence(1, {WALK}), {step('n', n)}, (w, q) -> if(day({on('w')}) > 12, w, {step('w', n)}), w -> date_format({on('w')}, '{other}'))"
        return f"if({day(form)} is not null, {got}, transform(array({day(other)}), n -> if(n between 0 and {SIDE * SIDE - 1}, {walked}, {m}))[0])"

    simple = f"""case
      when {full(EMAIL)} then concat(translate(substr({sha}, 1, 12), '0123456789', 'ghijklmnop'), '@', 'example.invalid')
      when {m} rlike '^AKIA[0-9A-Z]{{16}}$' then concat('AKIA', upper(substr({sha}, 1, 16)))
      when {m} like 'password=%' then concat('password=', substr({sha}, 1, least(32, greatest(8, length({m}) - 9))))
      when {m} rlike '^[0-9a-f]{{40}}$' then substr({sha}, 1, 40)
      when {full(ISO_DATE)} then {date('yyyy-MM-dd')}
      when {m} rlike '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$' then {date('dd/MM/yyyy', 'MM/dd/yyyy')}
      when {m} rlike '^[0-9]{{2}}[.][0-9]{{2}}[.][0-9]{{4}}$' then {date('dd.MM.yyyy')}
      when {full(SSN)} then {refill(m, digits_feistel(key, 'ssn', d))}
      when {full(IPV4)} then if(exists({octets}, x -> x > 255), {m}, {ip})
      when {full(PHONE)} then {refill(m, digits_feistel(key, 'phone', d))}
      else {m} end"""
    groups = f"{m} rlike '^[0-9]+([ -][0-9]+)*$' and length({d}) >= 13 and not {full(PHONE)} and not {m} rlike '^[0-9]{{40}}$'"
    return f"if({groups}, {cards_sql(key, m)}, transform(array({simple}), o -> named_struct('o', o, 'n', if(o = {m}, 0, 1)))[0])"


def pseudonymise(docs: DataFrame, key: str = DEMO_KEY) -> DataFrame:
    """``docs`` with text pseudonymised and n_found, the number of values replaced."""
    cols = [c for c in docs.columns if c != "n_found"]
    pattern = F.lit(ANY)
    rows = docs.select(*cols, F.coalesce(F.regexp_extract_all("text", pattern, F.lit(0)), F.array().cast("array<string>")).alias("__pii_m"))
    some = F.size("__pii_m") > 0
    new = F.expr(f"transform(__pii_m, m -> {pseudonym_sql(key)})")
    rows = rows.withColumn("__pii_p", F.when(some, new).otherwise(F.array().cast("array<struct<o:string,n:int>>")))
    parts = F.zip_with(F.split("text", ANY, -1), F.concat("__pii_p.o", F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    return rows.withColumns(
        {
            "n_found": F.aggregate("__pii_p.n", F.lit(0).cast("long"), lambda t, n: t + n),
            "text": F.when(some, F.array_join(parts, "")).otherwise(F.col("text")),
        }
    ).select(*cols, "n_found")
