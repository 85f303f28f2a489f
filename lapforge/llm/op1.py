"""Format-preserving pseudonyms for personal data, by keyed Feistel networks, in DataFrame operations only.

Found and validated: e-mail addresses, payment cards (Luhn), IBANs (mod 97), IPv4 addresses (octets), US social security
numbers (issued ranges), telephone numbers, and dates (calendar).  What fails its validation stays as it is.

A value is read as a pair (a, b) of Z_M x Z_K with M * K values, and ``ROUNDS`` rounds add a keyed function of one half to
the other: a permutation of exactly the valid values of its format, which is why a pseudonym is valid too, why two
values never get one pseudonym, and why the same value gets the same one in every document, however it is punctuated.
The keyed function is SHA-256 over a key, kind, size, round and half.  ``restore`` runs the rounds backwards.  The key in the
plan, and so in event logs, is one derived from the caller's by HMAC: the caller's own is never in it.  It opens pseudonyms all
the same, so let ``spark.sql.redaction.string.regex`` cover it where plans are kept (``[0-9a-f]{64}``).

* numbers: the digits are halved; separators and group lengths stay;
* cards keep their first digit and get a new check digit (next to further digits the value takes, if need be, a later one
  of its cycle, by which ``restore`` stays exact; after ``WALK`` steps, each of which fails about once in ten times, the last
  one stands: valid, and no longer sure to be restored), IBANs keep country and letters and get new check digits;
* telephone numbers keep the country code, which is found by the lengths of the codes in use and not by punctuation; in
  North American ones area and exchange stay in 2xx-9xx.  A trunk zero in brackets is part of a number.  Ten bare digits are
  taken for no telephone number;
* dates stay in their century (of 36 524 = 92 * 397 or 36 525 = 75 * 487 days) and keep their notation;
* addresses: letters of the part before the ``@`` are permuted as base-26 numbers, its digits as numbers; the domain stays.

A null text stays null with counts 0, an empty one stays empty; repeated rows and ties give equal results; texts of any
length are taken whole; an empty table gives no rows; other columns pass through ``pseudonymise`` unchanged.
"""

from __future__ import annotations

import hashlib
import hmac
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "iban", "date", "ssn", "card", "ip", "phone")

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
#: Countries by the length of their IBANs.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST",
    26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA",
    30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
_IBAN_BODIES = [
    f"(?:{of})[0-9]{{2}}(?:\\x20?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f"\\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, of in _IBAN_LENGTHS.items()
]
# the length of its country first, so that words behind an IBAN are no part of it; then any length
_IBAN = (
    rf"(?<![A-Za-z0-9])(?:{'|'.join(_IBAN_BODIES)}|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])"
)
_DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-]|\.[0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_CARD = r"(?<![0-9A-Za-z])(?:[0-9][\x20-]?){12,18}[0-9](?![0-9A-Za-z])"
_IP = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
_PHONE = (
    r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,4}){1,4}(?![0-9])"
    r"|(?<![0-9])\([2-9][0-9]{2}\)\x20?[0-9]{3}-[0-9]{4}(?![0-9])"
    r"|(?<![0-9.-])[2-9][0-9]{2}[.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])"
)
_PATTERNS = dict(zip(KINDS, (_EMAIL, _IBAN, _DATE, _SSN, _CARD, _IP, _PHONE), strict=True))
ANY = "|".join(_PATTERNS.values())
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Country calling codes of one and of two digits; all others have three.
_ONE = "^(1|7)"
_TWO = "^(20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|53|54|55|56|57|58|60|61|62|63|64|65|66|81|82|84|86|90|91|92|93|94|95|98)"


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Feistel:
    """SQL expressions of the keyed permutation; ``back`` inverts it."""

    key: str = field(repr=False)
    back: bool = False

    @property
    def derived(self) -> str:
        return hmac.new(self.key.encode(), b"format-preserving pseudonyms", hashlib.sha256).hexdigest()

    def pair(self, a: str, b: str, m: str, k: str, tweak: str) -> str:
        """struct(a, b) after all rounds, for a in Z_m and b in Z_k (bigint expressions)."""
        order = range(ROUNDS - 1, -1, -1) if self.back else range(ROUNDS)
        sign = "-" if self.back else "+"
        half = lambda x, n: (
            f"pmod(cast(conv(substr(sha2(concat_ws('|', {_sql_text(self.derived)}, {tweak}, {m}, {k}, i, {x}), 256), 1, 15), 16, 10)"
            f" as bigint), {n})"
        )
        return (
            f"aggregate(array({', '.join(map(str, order))}), named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)), (z, i) -> "
            f"if(i % 2 = 0, named_struct('a', pmod(z.a {sign} {half('z.b', m)}, {m}), 'b', z.b), "
            f"named_struct('a', z.a, 'b', pmod(z.b {sign} {half('z.a', k)}, {k}))))"
        )

    def number(self, digits: str, tweak: str) -> str:
        """Digits of the same length (up to 34) for a string of digits."""
        return (
            f"element_at(transform(array(named_struct('s', {digits}, 'u', length({digits}) div 2)), d -> "
            f"element_at(transform(array({self.pair('substr(concat(0, d.s), 1, d.u + 1)', 'substr(d.s, d.u + 1)', 'cast(rpad(1, d.u + 1, 0) as bigint)', 'cast(rpad(1, length(d.s) - d.u + 1, 0) as bigint)', tweak)}), "
            f"p -> concat(if(d.u > 0, lpad(cast(p.a as string), d.u, '0'), ''), lpad(cast(p.b as string), length(d.s) - d.u, '0'))), 1)), 1)"
        )

    def mixed(self, value: str, size_a: int, size_b: int, tweak: str) -> str:
        """A number below size_a * size_b for such a number."""
        p = self.pair(f"({value}) div {size_b}", f"({value}) % {size_b}", str(size_a), str(size_b), tweak)
        return f"element_at(transform(array({p}), p -> p.a * {size_b} + p.b), 1)"

    def word(self, letters: str, tweak: str) -> str:
        """Lower-case letters of the same length, in pieces of 24."""
        value = lambda s: f"aggregate(split({s}, ''), 0L, (t, c) -> if(c = '', t, t * 26 + instr('{_LETTERS}', c) - 1))"
        size = lambda n: f"aggregate(sequence(0, {n}), 1L, (t, j) -> if(j = 0, t, t * 26))"
        spell = lambda x, n: (
            f"if({n} = 0, '', aggregate(sequence(1, greatest({n}, 1)), named_struct('x', {x}, 's', ''), "
            f"(t, j) -> named_struct('x', t.x div 26, 's', concat(substr('{_LETTERS}', cast(t.x % 26 as int) + 1, 1), t.s)), t -> t.s))"
        )
        pair = self.pair(value("substr(d.s, 1, d.u)"), value("substr(d.s, d.u + 1)"), "d.m", "d.k", f"concat({tweak}, d.c)")
        return (
            f"array_join(transform(sequence(0, greatest(length({letters}) - 1, 0) div 24), c0 -> "
            f"element_at(transform(transform(array(substr({letters}, c0 * 24 + 1, 24)), s0 -> named_struct('s', s0, 'c', c0, 'u', length(s0) div 2, "
            f"'m', {size('length(s0) div 2')}, 'k', {size('length(s0) - length(s0) div 2')})), d -> "
            f"element_at(transform(array({pair}), p -> concat({spell('p.a', 'd.u')}, {spell('p.b', '(length(d.s) - d.u)')})), 1)), 1)), '')"
        )


def _refilled(shape: str, of: str, fill: str) -> str:
    """``shape`` with its characters that match ``of`` replaced in turn by those of ``fill``."""
    return (
        f"aggregate(split({shape}, ''), named_struct('s', '', 'i', 1), (t, c) -> if(c rlike '{of}', "
        f"named_struct('s', concat(t.s, substr({fill}, t.i, 1)), 'i', t.i + 1), named_struct('s', concat(t.s, c), 'i', t.i)), t -> t.s)"
    )


def _luhn(payload: str) -> str:
    """Check digit of a string of digits."""
    return (
        f"cast((10 - aggregate(transform(split(reverse({payload}), ''), (c, j) -> if(c = '', 0, if(j % 2 = 0, "
        f"(cast(c as int) * 2) div 10 + (cast(c as int) * 2) % 10, cast(c as int)))), 0L, (t, x) -> t + x) % 10) % 10 as string)"
    )


def _mod97(text: str) -> str:
    return (
        f"aggregate(split({text}, ''), 0, (t, c) -> if(c = '', t, if(c rlike '[0-9]', (t * 10 + cast(c as int)) % 97, "
        f"(t * 100 + ascii(c) - 55) % 97)))"
    )


def _let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


_DIGITS = "regexp_replace({}, '[^0-9]', '')"


def _date_cases(f: Feistel) -> str:
    """Dates: number of the day in its century, permuted there."""
    out = []
    for shape, form in (("-", "yyyy-MM-dd"), (".", "dd.MM.yyyy"), ("/", "MM/dd/yyyy"), ("/", "dd/MM/yyyy")):
        first = "make_date(((year(day) - 1) div 100) * 100 + 1, 1, 1)"
        index = f"cast(datediff(day, {first}) as bigint)"
        long_ = "((year(day) - 1) div 100 + 1) % 4 = 0"
        new = f"date_format(date_add({first}, cast(if({long_}, {f.mixed(index, 75, 487, _sql_text('date'))}, {f.mixed(index, 92, 397, _sql_text('date'))}) as int)), '{form}')"
        day = f"try_to_date(v, '{form}')"
        out.append(f"when contains(v, '{shape}') and {day} is not null and year({day}) between 1 and 9999 then {_let(day, 'day', new)}")
    return "case " + " ".join(out) + " end"


#: Steps after which the search for a pseudonym that no earlier reading takes for a card ends.
WALK = 256


def _card(f: Feistel) -> str:
    """The first valid reading: all of the match, else what begins and ends at its separators, longest and leftmost first.

    The permutation is repeated until no earlier reading of the result is valid, so that ``restore`` takes the same one.
    """
    starts = "filter(sequence(1, length(v)), x1 -> x1 = 1 or substr(v, x1 - 1, 1) rlike '[^0-9]')"
    ends = "filter(sequence(1, length(v)), y1 -> y1 = length(v) or substr(v, y1 + 1, 1) rlike '[^0-9]')"
    every = f"flatten(transform({starts}, a1 -> transform({ends}, b1 -> named_struct('a', a1, 'z', b1 - a1 + 1))))"
    digits = _DIGITS.format("substr(v, r1.a, greatest(r1.z, 0))")
    fit = f"filter({every}, r1 -> substr(v, r1.a, 1) rlike '[0-9]' and length({digits}) between 13 and 19)"
    readings = f"array_sort({fit}, (l1, l2) -> (l2.z - l1.z) * 100 + l1.a - l2.a)"
    valid = lambda text: _let(_DIGITS.format(text), "n", f"{_luhn('substr(n, 1, length(n) - 1)')} = substr(n, -1, 1)")
    payload = "concat(substr(n, 1, 1), " + f.number("substr(n, 2, length(n) - 2)", _sql_text("card")) + ")"
    new = _let(_DIGITS.format("w1"), "n", _let(payload, "q", _refilled("w1", "[0-9]", f"concat(q, {_luhn('q')})")))
    step = f"concat(substr(k1.s, 1, o1.a - 1), {_let('substr(k1.s, o1.a, o1.z)', 'w1', new)}, substr(k1.s, o1.a + o1.z))"
    taken = f"exists(slice(m1, 1, h1 - 1), e1 -> {valid('substr(u1, e1.a, e1.z)')})"
    after = f"named_struct('s', u1, 'done', not {taken})"
    walk = (
        f"aggregate(sequence(1, if(h1 = 1, 1, {WALK})), named_struct('s', v, 'done', false), (k1, i1) -> "
        f"if(k1.done, k1, {_let(step, 'u1', after)}), k1 -> k1.s)"
    )
    first = f"cast(array_position(transform(m1, r2 -> {valid('substr(v, r2.a, r2.z)')}), true) as int)"
    return _let(readings, "m1", _let(first, "h1", f"if(h1 = 0, null, {_let('element_at(m1, greatest(h1, 1))', 'o1', walk)})"))


def _iban(f: Feistel) -> str:
    plain = "replace(v, ' ', '')"
    bban_digits = "regexp_replace(substr(n, 5), '[^0-9]', '')"
    body = _let(bban_digits, "g", f"if(g = '', substr(n, 5), {_refilled('substr(n, 5)', '[0-9]', '(' + f.number('g', _sql_text('iban')) + ')')})")
    check = f"lpad(cast(98 - {_mod97('concat(b, substr(n, 1, 2), 0, 0)')} as string), 2, '0')"
    new = _let(body, "b", _refilled("v", "[A-Z0-9]", f"concat(substr(n, 1, 2), {check}, b)"))
    return _let(plain, "n", f"if(length(n) between 15 and 34 and {_mod97('concat(substr(n, 5), substr(n, 1, 4))')} = 1, {new}, null)")


def _ip(f: Feistel) -> str:
    value = "aggregate(o, 0L, (t, x) -> t * 256 + cast(x as int))"
    new = _let(f.mixed(value, 65536, 65536, _sql_text("ip")), "x", "concat_ws('.', x div 16777216, x div 65536 % 256, x div 256 % 256, x % 256)")
    plain = "forall(o, x -> cast(x as int) <= 255 and (x = '0' or not startswith(x, '0')))"
    return _let("split(v, '[.]')", "o", f"if({plain}, {new}, null)")


def _ssn(f: Feistel) -> str:
    area, group, serial = "cast(substr(v, 1, 3) as bigint)", "cast(substr(v, 5, 2) as bigint)", "cast(substr(v, 8, 4) as bigint)"
    valid = f"{area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0"
    value = f"({area} - if({area} > 666, 2, 1)) * 989901 + ({group} - 1) * 9999 + {serial} - 1"
    new = _let(
        f.mixed(value, 898, 989901, _sql_text("ssn")),
        "x",
        "concat_ws('-', lpad(x div 989901 + if(x div 989901 >= 665, 2, 1), 3, '0'), lpad(x % 989901 div 9999 + 1, 2, '0'), "
        "lpad(x % 989901 % 9999 + 1, 4, '0'))",
    )
    return f"if({valid}, {new}, null)"


def _phone(f: Feistel) -> str:
    """The number without its country code; North American ones keep valid area and exchange codes."""
    tail = "substr(n, -10, 10)"
    value = (
        f"(cast(substr({tail}, 1, 3) as bigint) - 200) * 8000000 + (cast(substr({tail}, 4, 3) as bigint) - 200) * 10000"
        f" + cast(substr({tail}, 7, 4) as bigint)"
    )
    american = f"((length(n) = 11 and startswith(v, '+1')) or (length(n) = 10 and not startswith(v, '+'))) and {tail} rlike '^[2-9]..[2-9]'"
    new = _let(
        f.mixed(value, 640000, 10000, _sql_text("phone")),
        "x",
        "concat(substr(n, 1, length(n) - 10), x div 8000000 + 200, x % 8000000 div 10000 + 200, lpad(x % 10000, 4, '0'))",
    )
    code = f"if(startswith(v, '+'), case when n rlike '{_ONE}' then 1 when n rlike '{_TWO}' then 2 else 3 end, 0)"
    other = _let(code, "e", f"concat(substr(n, 1, e), {f.number('substr(n, e + 1)', _sql_text('phone'))})")
    both = _let(f"if({american}, {new}, {other})", "q", _refilled("v", "[0-9]", "q"))
    return _let(_DIGITS.format("v"), "n", f"if(length(n) between 8 and 15, {both}, null)")


def _email(f: Feistel) -> str:
    local = "lower(substring_index(v, '@', 1))"
    letters = _let("regexp_replace(w, '[^a-z]', '')", "g", f"if(g = '', w, {_refilled('w', '[a-z]', '(' + f.word('g', _sql_text('email')) + ')')})")
    chunks = f"array_join(transform(sequence(0, greatest(length(h) - 1, 0) div 18), c1 -> {_let('substr(h, c1 * 18 + 1, 18)', 'h1', f.number('h1', _sql_text('email')))}), '')"
    digits = _let("regexp_replace(y, '[^0-9]', '')", "h", f"if(h = '', y, {_refilled('y', '[0-9]', '(' + chunks + ')')})")
    return _let(local, "w", f"concat({_let(letters, 'y', digits)}, '@', substring_index(v, '@', -1))")


_RULES = {"email": _email, "iban": _iban, "date": _date_cases, "ssn": _ssn, "card": _card, "ip": _ip, "phone": _phone}


def _replacement(f: Feistel) -> str:
    """struct(kind, text) for a match v; kind is null where the validation fails."""
    kind = "case " + " ".join(f"when v rlike {_sql_text('^(?:' + _PATTERNS[k] + ')$')} then {_sql_text(k)}" for k in KINDS) + " end"
    cases = "case k " + " ".join(f"when {_sql_text(k)} then {_RULES[k](f)}" for k in KINDS) + " end"
    return _let(kind, "k", _let(cases, "r", "named_struct('kind', if(r is null, null, k), 'text', coalesce(r, v))"))


def _replaced(docs: DataFrame, text: str, f: Feistel) -> DataFrame:
    t = f"`{text}`"
    found = f"if({t} rlike '[0-9@]', regexp_extract_all({t}, {_sql_text(ANY)}, 0), cast(array() as array<string>))"
    cast = "array<struct<kind: string, text: string>>"
    return docs.withColumn("__found", F.expr(found)).withColumn(
        "__new", F.expr(f"if(size(__found) > 0, transform(__found, v -> {_replacement(f)}), cast(array() as {cast}))")
    ).withColumn(
        "__text",
        F.expr(
            f"if(size(__found) > 0, array_join(zip_with(split({t}, {_sql_text(ANY)}, -1), __new, "
            f"(g, m) -> concat(g, coalesce(m.text, ''))), ''), {t})"
        ),
    )


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and a count n_<kind> per kind (replacing columns of those names)."""
    done = _replaced(docs, text, Feistel(key))
    names = [f"n_{k}" for k in KINDS]
    counts = [F.expr(f"cast(size(filter(coalesce(__new, array()), m -> m.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    kept = [F.col("__text").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns if c not in names]
    return done.select(*kept, *counts)


def restore(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The inverse of ``pseudonymise`` for a holder of the key (addresses come back in lower case)."""
    done = _replaced(docs, text, Feistel(key, back=True))
    return done.select(*[F.col("__text").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns])
