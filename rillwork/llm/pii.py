"""Format-preserving Feistel pseudonyms for personal data.

Values that pass their format's validation are replaced by others of the same
format, by a keyed permutation of the format's domain, so that equal values
have equal pseudonyms in all documents and different values different ones:

* dates (ISO, or day first with slashes or dots) that the calendar has, within
  1800-2199: the 146,097 days of that Gregorian cycle are 189 x 773 (a date that
  is valid only with its month first is not taken for one, as its pseudonym could
  be read either way);
* payment card numbers of 13-19 digits with a valid Luhn digit: all digits but the
  last are permuted and the Luhn digit is made anew (again and again, where groups of digits
  like those of telephone numbers would make the result read as another format);
* IPv4 addresses: two halves of 16 bits;
* social security numbers with valid area, group and serial;
* North American telephone numbers with valid area and exchange codes, and those
  that a plus sign or brackets mark as such whatever their codes, which keep to
  codes of their kind;
* e-mail addresses: each run of letters and digits before the @, every character
  within its class (digit, lower or upper case).

A domain is the product of two ranges, a and b; the rounds add a keyed hash
of one coordinate to the other, modulo its range, in turn, which permutes the domain
exactly, whatever the ranges. Undoing subtracts in the reverse order, so ``undo``
restores the text. Separators and punctuation stay as they are.

All of it is SQL functions: a text is cut at its matches, the matches are
mapped, and the pieces are joined again.

Defined results: a null text stays null with no replacement; an empty text stays
empty; values that fail validation stay; overlapping candidates are taken from
the left, the longest format first, but a card candidate ends before a valid phone, social security number
or ISO date, and before a blank and a whole card of 16 digits (together or in fours); of a candidate without a valid Luhn digit, a card of
16 or 15 digits in the usual groups that begins it and ends at a separator is taken, if its own is valid (fours of digits
on both sides of a card hide it); rows that repeat get equal results; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

_DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})"
_IP = r"\d{1,3}(?:\.\d{1,3}){3}"
_PHONE = r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
_SSN = r"\d{3}-\d{2}-\d{4}"
_CARD = r"\d(?:[ -]?\d){12,18}"
_EMAIL = r"(?<![A-Za-z0-9])[A-Za-z0-9]++(?=[A-Za-z0-9._%+-]{0,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
_FIRST, _LAST = r"(?<![0-9])(?<![0-9][.-])", r"(?![0-9])(?![.-][0-9])"

#: Values whose layout and codes are valid: no card goes on into one. Pseudonyms keep to these codes, so ``undo`` finds the same values.
_SURE_PHONE = r"(?:1[ .-]?)?[2-9]\d{2}[ .-][2-9]\d{2}[ .-]\d{4}"
_SURE_SSN = r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}"
_SURE_DATE = r"(?:1[89]|2[01])\d{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])"
#: A card by its layout alone, which a pseudonym keeps; one four more would leave open where it begins.
_SURE_CARD = r"(?:\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{16})(?!\d)(?!-\d)(?! \d{4}(?!\d))"
_WHOLE_CARD = _CARD.replace("[ -]?", f"(?:(?:-| (?!{_SURE_CARD}))(?!(?:{_SURE_PHONE}|{_SURE_SSN}|{_SURE_DATE}){_LAST}))?")
#: A card that another number follows in one candidate.
_HEAD_CARD = r"^(?:\d{4}(?:[ -]?\d{4}){3}|\d{4}[ -]?\d{6}[ -]?\d{5})(?=[ -])"

#: A run before an @ may go on after a dot or the like, so the look-ahead admits what an address's name may hold.
PATTERN = f"{_EMAIL}|{_FIRST}(?:{_DATE}|{_IP}|{_SSN}|{_SURE_PHONE}|{_WHOLE_CARD}|{_PHONE}){_LAST}"


def _q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hash(key: str, kind: str, size: str, turn: str, value: str) -> str:
    """A keyed 60-bit hash as a bigint."""
    return f"cast(conv(substring(sha2(concat_ws('|', {_q(key)}, {_q(kind)}, {size}, {turn}, {value}), 256), 1, 15), 16, 10) as bigint)"


def _feistel(key: str, kind: str, size: str, a: str, b: str, range_a: str, range_b: str, undo: bool) -> str:
    """SQL for a struct of the permuted coordinates; all arguments are SQL."""
    sign = "-" if undo else "+"
    step_a = f"pmod(s.a {sign} pmod({_hash(key, kind, size, 'r', 's.b')}, {range_a}), {range_a})"
    step_b = f"pmod(s.b {sign} pmod({_hash(key, kind, size, 'r', 's.a')}, {range_b}), {range_b})"
    turns = f"sequence({ROUNDS - 1}, 0, -1)" if undo else f"sequence(0, {ROUNDS - 1})"
    start = f"named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint))"
    return f"aggregate({turns}, {start}, (s, r) -> if(r % 2 = 0, named_struct('a', {step_a}, 'b', s.b), named_struct('a', s.a, 'b', {step_b})))"


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _refilled(template: str, new: str) -> str:
    """SQL: the digits of ``template`` replaced in order by those of ``new``."""
    place = f"length({_digits(f'substring({template}, 1, i)')})"
    return f"array_join(transform(sequence(1, length({template})), i -> if(substring({template}, i, 1) rlike '[0-9]', substring({new}, {place}, 1), substring({template}, i, 1))), '')"


def _luhn(digits: str) -> str:
    """SQL: the Luhn sum of a string of digits, the last of which counts once."""
    d = f"cast(substring({digits}, length({digits}) - i, 1) as int)"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (t, i) -> t + if(i % 2 = 0, {d}, if(2 * {d} > 9, 2 * {d} - 9, 2 * {d})))"


def _decimal(key: str, kind: str, digits: str, undo: bool) -> str:
    """SQL: a string of 2 to 18 digits permuted among those of its length."""
    half = f"cast(length({digits}) div 2 as int)"
    a, b = f"substring({digits}, 1, {half})", f"substring({digits}, {half} + 1)"
    range_a, range_b = f"cast(pow(10, {half}) as bigint)", f"cast(pow(10, length({digits}) - {half}) as bigint)"
    f = _feistel(key, kind, f"length({digits})", a, b, range_a, range_b, undo)
    return _let("f", f, f"concat(lpad(cast(f.a as string), {half}, '0'), lpad(cast(f.b as string), length({digits}) - {half}, '0'))")


def _card(key: str, undo: bool) -> str:
    body = _let("p", _decimal(key, "card", "substring(d, 1, length(d) - 1)", undo), _refilled("m", f"concat(p, cast(pmod(10 - {_luhn("concat(p, '0')")} % 10, 10) as string))"))
    once = lambda m: _let("m", m, _let("d", _digits("m"), body))
    # Where its groups can look like another format, the permutation is repeated until the card reads as one again.
    walk = f"aggregate(sequence(1, 64), {once('m')}, (c, turn) -> if(regexp_extract(c, {_q(PATTERN)}, 0) = c, c, {once('c')}))"
    mixed = f"m rlike {_q(r'[0-9]{3}[ -][0-9]{2,3}[ -][0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2}')}"
    # A card that begins a longer candidate: repeated until the whole has no valid Luhn digit, as before, so that undo takes the same part.
    head = lambda c: f"regexp_extract({c}, {_q(_HEAD_CARD)}, 0)"
    invalid = lambda c: _let("w", _digits(c), f"{_luhn('w')} % 10 <> 0")
    turned = lambda c: _let("c0", c, _let("h", head("c0"), f"concat({once('h')}, substring(c0, length(h) + 1))"))
    part = f"aggregate(sequence(1, 64), {turned('m')}, (c, turn) -> if(regexp_extract(c, {_q(PATTERN)}, 0) = c and {invalid('c')}, c, {turned('c')}))"
    begins = _let("h", head("m"), f"h <> '' and not {invalid('h')}")
    return _let("d", _digits("m"), f"case when {_luhn('d')} % 10 <> 0 then if({begins}, {part}, m) when {mixed} then {walk} else {once('m')} end")


def _date(key: str, undo: bool) -> str:
    def by(pattern: str) -> str:
        day = f"datediff(t, date'1800-01-01')"
        f = _feistel(key, "date", "0", f"{day} div 773", f"{day} % 773", "189L", "773L", undo)
        new = _let("f", f, f"date_format(date_add(date'1800-01-01', cast(f.a * 773 + f.b as int)), '{pattern}')")
        return _let("t", f"to_date(try_to_timestamp(m, '{pattern}'))", f"if(t >= date'1800-01-01' and t < date'2200-01-01', {new}, null)")

    return f"case when m like '%-%' then coalesce({by('yyyy-MM-dd')}, m) when m like '%/%' then coalesce({by('dd/MM/yyyy')}, m) else coalesce({by('dd.MM.yyyy')}, m) end"


def _ip(key: str, undo: bool) -> str:
    o = lambda k: f"cast(o[{k}] as int)"
    f = _feistel(key, "ip", "0", f"{o(0)} * 256 + {o(1)}", f"{o(2)} * 256 + {o(3)}", "65536L", "65536L", undo)
    new = _let("f", f, "concat_ws('.', cast(f.a div 256 as string), cast(f.a % 256 as string), cast(f.b div 256 as string), cast(f.b % 256 as string))")
    return _let("o", "split(m, '[.]')", f"if(forall(o, x -> cast(x as int) < 256 and (x = '0' or x not like '0%')), {new}, m)")


def _ssn(key: str, undo: bool) -> str:
    area, group, serial = (f"cast(substring(d, {at}, {n}) as int)" for at, n in ((1, 3), (4, 2), (6, 4)))
    a = f"if({area} > 666, {area} - 2, {area} - 1)"
    f = _feistel(key, "ssn", "0", a, f"({group} - 1) * 9999 + {serial} - 1", "898L", "989901L", undo)
    back = "lpad(cast(if(f.a >= 665, f.a + 2, f.a + 1) as string), 3, '0'), lpad(cast(f.b div 9999 + 1 as string), 2, '0'), lpad(cast(f.b % 9999 + 1 as string), 4, '0')"
    new = _let("f", f, _let("n", f"concat({back})", _refilled("m", "n")))
    return _let("d", _digits("m"), f"if({area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0, {new}, m)")


def _phone(key: str, undo: bool) -> str:
    area, exchange, line = (f"cast(substring(right(d, 10), {at}, {n}) as int)" for at, n in ((1, 3), (4, 3), (7, 4)))

    def among(kind: str, area_from: int, areas: int, exchange_from: int, exchanges: int) -> str:
        f = _feistel(key, kind, "0", f"{area} - {area_from}", f"({exchange} - {exchange_from}) * 10000 + {line}", f"{areas}L", f"{exchanges}0000L", undo)
        back = f"substring(d, 1, length(d) - 10), lpad(cast(f.a + {area_from} as string), 3, '0'), lpad(cast(f.b div 10000 + {exchange_from} as string), 3, '0'), lpad(cast(f.b % 10000 as string), 4, '0')"
        return _let("f", f, _let("n", f"concat({back})", _refilled("m", "n")))

    valid, low_area, low_exchange = among("phone", 200, 800, 200, 800), among("phone-area", 0, 200, 0, 1000), among("phone-exchange", 200, 800, 0, 200)
    marked = "(m like '+%' or m like '%(%')"
    return _let("d", _digits("m"), f"case when {area} >= 200 and {exchange} >= 200 then {valid} when not {marked} then m when {area} < 200 then {low_area} else {low_exchange} end")


def _run(key: str, undo: bool) -> str:
    """A run of letters and digits, in pieces of up to 10: every character keeps its class (digit, lower or upper case).

    A piece is a number whose places have 10 or 26 values each; pieces of
    one pattern of classes are permuted among themselves.
    """
    symbols = lambda v: f"regexp_extract_all({v}, '.', 0)"
    radix = "if(c <= '9', 10L, 26L)"
    zero = "case when c <= '9' then 48 when c <= 'Z' then 65 else 97 end"
    half = "cast(length(x) div 2 as int)"
    a, b = f"substring(x, 1, {half})", f"substring(x, {half} + 1)"
    number = lambda v: f"aggregate({symbols(v)}, 0L, (n, c) -> n * {radix} + ascii(c) - {zero})"
    size = lambda v: f"aggregate({symbols(v)}, 1L, (n, c) -> n * {radix})"
    written = lambda n, v: f"aggregate(reverse({symbols(v)}), named_struct('n', {n}, 't', ''), (z, c) -> named_struct('n', z.n div {radix}, 't', concat(char(z.n % {radix} + {zero}), z.t)), z -> z.t)"
    pattern = "regexp_replace(regexp_replace(regexp_replace(x, '[0-9]', '0'), '[a-z]', 'a'), '[A-Z]', 'A')"
    f = _feistel(key, "run", "k.p", number(a), number(b), "k.a", "k.b", undo)
    new = _let("f", f, f"concat({written('f.a', a)}, {written('f.b', b)})")
    each = _let("k", f"named_struct('p', {pattern}, 'a', {size(a)}, 'b', {size(b)})", new)
    return f"array_join(transform(regexp_extract_all(m, '[A-Za-z0-9]{{1,10}}', 0), x -> {each}), '')"


def pseudonym_sql(key: str, undo: bool = False) -> str:
    """SQL over ``m``, a match of PATTERN: its pseudonym, or ``m`` itself if it is not valid."""
    full = lambda p: _q(f"^(?:{p})$")
    return (
        f"case when m rlike {full(_DATE)} then {_date(key, undo)} when m rlike {full(_IP)} then {_ip(key, undo)} "
        f"when m rlike {full(_SSN)} then {_ssn(key, undo)} when m rlike {full(_CARD)} then {_card(key, undo)} "
        f"when m rlike {full(_PHONE)} then {_phone(key, undo)} else {_run(key, undo)} end"
    )


def pseudonymised(text: Column | str, key: str, undo: bool = False) -> Column:
    """A struct of ``text`` and ``n_replaced``. text: the name of a string column."""
    found = f"regexp_extract_all({text}, {_q(PATTERN)}, 0)"
    joined = f"array_join(zip_with(split({text}, {_q(PATTERN)}, -1), new, (p, n) -> concat(p, coalesce(n, ''))), '')"
    changed = "cast(size(filter(zip_with(old, new, (o, n) -> o <> n), x -> x)) as bigint)"
    body = _let("new", f"transform(old, m -> {pseudonym_sql(key, undo)})", f"named_struct('text', {joined}, 'n_replaced', {changed})")
    whole = _let("old", found, f"if(size(old) = 0, named_struct('text', {text}, 'n_replaced', 0L), {body})")
    return F.expr(f"if({text} is null, named_struct('text', cast(null as string), 'n_replaced', 0L), {whole})")


def pseudonymise(docs: DataFrame, key: str, undo: bool = False) -> DataFrame:
    """``(doc_id, text, n_replaced)``, a row per input row; ``undo`` takes pseudonyms back."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("__text"))
    return rows.select("doc_id", pseudonymised("__text", key, undo).alias("__new")).select("doc_id", "__new.text", "__new.n_replaced")
