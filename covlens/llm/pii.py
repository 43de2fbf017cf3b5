"""Format-preserving pseudonyms for personal data, by SQL functions alone.

A value is found by its pattern, validated (Luhn, mod 97, calendar, octets, area
codes) and mapped by a keyed Feistel network on its own domain, so the pseudonym is
valid where the value was, distinct values of a format stay distinct, and equal values
are equal in every document:

* numbers that live in a range are halves of Z_a x Z_b with a * b the size of the
  range (dates: the 146,097 days of 1800 to 2199; IPv4; US numbers and SSNs), and
  each round adds a hash of one half to the other;
* other values are two halves of characters, and each round shifts every letter or
  digit of one half by a hash of the other, within its own alphabet. Check digits of
  cards and IBANs are computed anew.

Kept as they are: separators, an e-mail's domain, a phone's country code, an IBAN's
country, whatever fails validation. Null texts stay null with 0 replaced; a text
that ``SOME`` does not find is passed through, as every pattern needs one of its
characters; repeated rows are treated alike.
Nothing is shuffled. Whoever has the key can undo the mapping, so there is none in the code: it is
a parameter, or the setting ``KEY_CONF`` of the session, or else drawn anew in each session, which
links values within the session only.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covlens.llm.common import spare, table
from covlens.session import session_key

ROUNDS = 8
KEY_CONF = "spark.covlens.pseudonym.key"
_drawn: dict[str, str] = {}

#: Kind, and its pattern. At a place the first that fits counts.
PATTERNS: list[tuple[str, str]] = [
    ("secret", r'(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|(?i:token|password|passwd|secret|api[_-]?key)\s{0,2}[=:]\s{0,2}"?[A-Za-z0-9_+/-]{8,}+)'),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)+"),
    ("ip", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"),
    ("date", r"(?<![\w./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4})(?!(?!T\d)[\w/]|[.-]\d)"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("phone", r"(?<![\w+])(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}|[2-9]\d{2} [2-9]\d{2} \d{4}|\+[2-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,5})(?!\w)"),
    ("card", r"(?<!\w)(?:\d{13,19}|\d{4}(?: \d{4}){2} \d{1,7}|\d{4}(?:-\d{4}){2}-\d{1,7}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?!\w)"),
    ("iban", r"(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?!\w)"),
]
ANY = "|".join(f"(?:{p})" for _, p in PATTERNS)
#: Implied by every pattern.
SOME = "[0-9@=:]|AKIA"


def quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def only(s: str, kept: str) -> str:
    return f"regexp_replace({s}, '[^{kept}]', '')"


def digits(s: str) -> str:
    return only(s, "0-9")


def number(s: str, first: int, size: int) -> str:
    return f"cast(substr({s}, {first}, {size}) as bigint)"


def feistel_numbers(key: str, kind: str, left: str, right: str, a: int, b: int) -> str:
    """SQL for the struct (l, r) that (left, right) of Z_a x Z_b is mapped to."""

    def added(half: str, other: str, size: int) -> str:
        h = f"cast(conv(substr(sha2(concat_ws(':', {quoted(key)}, '{kind}', k, {other}), 256), 1, 12), 16, 10) as bigint)"
        return f"({half} + {h}) % {size}"

    return (f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint)), (s, k) -> if(k % 2 = 0, "
            f"named_struct('l', {added('s.l', 's.r', a)}, 'r', s.r), named_struct('l', s.l, 'r', {added('s.r', 's.l', b)})))")


def feistel_chars(key: str, kind: str, s: str) -> str:
    """SQL for the string that ``s`` (lower case) is mapped to: digits to digits, a-z to a-z, the rest stays."""

    def shifted(half: str, other: str) -> str:
        h = f"sha2(concat_ws(':', {quoted(key)}, '{kind}', k, {other}), 512)"
        c, v = f"substr({half}, i, 1)", f"cast(conv(substr({h}, 1 + 4 * ((i - 1) % 32), 4), 16, 10) as int)"
        one = (f"case when {c} rlike '[0-9]' then substr('0123456789', 1 + (ascii({c}) - 48 + {v}) % 10, 1) "
               f"when {c} rlike '[a-z]' then substr('abcdefghijklmnopqrstuvwxyz', 1 + (ascii({c}) - 97 + {v}) % 26, 1) else {c} end")
        return f"array_join(transform(if(length({half}) > 0, sequence(1, length({half})), array()), i -> {one}), '')"

    whole = (f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('l', substr({s}, 1, int(length({s}) / 2)), 'r', substr({s}, 1 + int(length({s}) / 2))), (t, k) -> if(k % 2 = 0, "
             f"named_struct('l', {shifted('t.l', 't.r')}, 'r', t.r), named_struct('l', t.l, 'r', {shifted('t.r', 't.l')})), t -> concat(t.l, t.r))")
    return whole


def bound(value: str, name: str, body: str) -> str:
    """SQL ``body`` with ``name`` standing for ``value``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def refilled(template: str, kept: str, filling: str) -> str:
    """``template`` with its characters of class ``kept`` replaced by those of ``filling`` in turn, in the case of the former."""
    c = f"substr({template}, j, 1)"
    new = f"substr({filling}, length({only(f'substr({template}, 1, j)', kept)}), 1)"
    return f"array_join(transform(sequence(1, length({template})), j -> if({c} rlike '[{kept}]', if({c} rlike '[A-Z]', upper({new}), {new}), {c})), '')"


def luhn(s: str) -> str:
    d = f"cast(substr({s}, -i, 1) as int)"
    return f"aggregate(sequence(1, length({s})), 0, (t, i) -> t + if(i % 2 = 0, if({d} > 4, 2 * {d} - 9, 2 * {d}), {d}))"


def mod97(s: str) -> str:
    c = f"substr({s}, i, 1)"
    return f"aggregate(sequence(1, length({s})), 0, (t, i) -> if({c} rlike '[0-9]', (t * 10 + ascii({c}) - 48) % 97, (t * 100 + ascii({c}) - 55) % 97))"


def pseudonym(m: str, key: str) -> str:
    """SQL for the pseudonym of the matched text ``m``."""

    def secret() -> str:
        # what is assigned, or the whole of an access key after its fixed first letters
        value = f"if({m} rlike '^AKIA', substr({m}, 5), regexp_extract({m}, '([A-Za-z0-9_+/-]+)$', 1))"
        return bound(value, "v", f"concat(substr({m}, 1, length({m}) - length(v)), {bound(feistel_chars(key, 'secret', 'lower(v)'), 'w', refilled('v', 'A-Za-z0-9_+/-', 'w'))})")

    def email() -> str:
        return bound(f"substring_index({m}, '@', 1)", "v",
                     f"concat({bound(feistel_chars(key, 'email', 'lower(v)'), 'w', refilled('v', 'A-Za-z0-9._%+-', 'w'))}, substr({m}, length(v) + 1))")

    def ip() -> str:
        o = [f"cast(split({m}, '[.]')[{i}] as int)" for i in range(4)]
        f = feistel_numbers(key, "ip", f"{o[0]} * 256 + {o[1]}", f"{o[2]} * 256 + {o[3]}", 65536, 65536)
        out = bound(f, "v", "concat_ws('.', int(v.l / 256), v.l % 256, int(v.r / 256), v.r % 256)")
        return f"if(greatest({', '.join(o)}) < 256, {out}, {m})"

    def date() -> str:
        def form(y: str, mo: str, d: str, pattern: str) -> str:
            days = f"case when {mo} in (4, 6, 9, 11) then 30 when {mo} = 2 then if({y} % 4 = 0 and ({y} % 100 != 0 or {y} % 400 = 0), 29, 28) else 31 end"
            day = f"datediff(make_date({y}, {mo}, {d}), date'1800-01-01')"
            f = bound(day, "n", feistel_numbers(key, "date", "int(n / 773)", "n % 773", 189, 773))
            out = bound(f, "v", f"date_format(date_add(date'1800-01-01', cast(v.l * 773 + v.r as int)), '{pattern}')")
            # a day or month of one digit: none has a leading zero
            out = bound(out, "o", f"if(length({m}) < 10, regexp_replace(o, '(^|[./-])0', '$1'), o)")
            return f"when {y} between 1800 and 2199 and {mo} between 1 and 12 and {d} >= 1 and {d} <= {days} then {out}"

        x, y, z = (f"cast(split({m}, '[./-]')[{i}] as int)" for i in range(3))
        sep = f"if({m} rlike '^[0-9]{{4}}', substr({m}, 5, 1), substr({m}, -5, 1))"
        ymd = " ".join(f"when {m} rlike '^[0-9]{{4}}' and {sep} = '{s}' then case {form(x, y, z, f'yyyy{s}MM{s}dd')} else {m} end" for s in "-/")
        last = " ".join(
            f"when {sep} = '{s}' then case {' '.join(form(z, mo, d, p) for mo, d, p in ways)} else {m} end"
            for s, ways in ((".", [(y, x, "dd.MM.yyyy")]),
                            ("/", [(x, y, "MM/dd/yyyy"), (y, x, "dd/MM/yyyy")]),
                            ("-", [(y, x, "dd-MM-yyyy"), (x, y, "MM-dd-yyyy")])))
        return f"case {ymd} {last} else {m} end"

    def ssn() -> str:
        # areas 1-665 and 667-899, groups 1-99, serials 1-9999
        a, g, n = (f"cast(substr({m}, {i}, {k}) as int)" for i, k in ((1, 3), (5, 2), (8, 4)))
        f = feistel_numbers(key, "ssn", f"if({a} > 666, {a} - 2, {a} - 1)", f"({g} - 1) * 9999 + {n} - 1", 898, 99 * 9999)
        out = bound(f, "v", "concat_ws('-', lpad(string(if(v.l >= 665, v.l + 2, v.l + 1)), 3, '0'), lpad(string(int(v.r / 9999) + 1), 2, '0'), lpad(string(v.r % 9999 + 1), 4, '0'))")
        return f"if({a} between 1 and 899 and {a} != 666 and {g} > 0 and {n} > 0, {out}, {m})"

    def phone() -> str:
        code = f"regexp_extract({m}, '^([+]1|[+][0-9]+)[ .(-]', 1)"
        rest = "substr({m}, length(c) + 1)".format(m=m)
        us = feistel_numbers(key, "phone", f"{number('d', 1, 3)} - 200", f"({number('d', 4, 3)} - 200) * 10000 + {number('d', 7, 4)}", 800, 800 * 10000)
        mapped = (f"if(length(d) = 10 and {number('d', 1, 1)} >= 2 and {number('d', 4, 1)} >= 2, "
                  f"{bound(us, 'v', 'concat(string(v.l + 200), string(int(v.r / 10000) + 200), lpad(string(v.r % 10000), 4, chr(48)))')}, {feistel_chars(key, 'phone', 'd')})")
        return bound(code, "c", bound(digits(rest), "d", bound(mapped, "w", f"concat(c, {bound(rest, 'z', refilled('z', '0-9', 'w'))})")))

    def card() -> str:
        payload = bound(feistel_chars(key, "card", "substr(d, 1, length(d) - 1)"), "p", f"concat(p, string((10 - {luhn('concat(p, chr(48))')} % 10) % 10))")
        return bound(digits(m), "d", f"if(length(d) between 13 and 19 and {luhn('d')} % 10 = 0 and d rlike '[1-9]', {bound(payload, 'w', refilled(m, '0-9', 'w'))}, {m})")

    def iban() -> str:
        fresh = bound(f"upper({feistel_chars(key, 'iban', 'lower(substr(d, 5))')})", "p",
                      f"concat(substr(d, 1, 2), lpad(string(98 - {mod97('concat(p, substr(d, 1, 2), chr(48), chr(48))')}), 2, '0'), p)")
        return bound(f"replace({m}, ' ', '')", "d", f"if(length(d) between 15 and 34 and {mod97('concat(substr(d, 5), substr(d, 1, 4))')} = 1, {bound(fresh, 'w', refilled(m, 'A-Z0-9', 'w'))}, {m})")

    make = {"secret": secret, "email": email, "ip": ip, "date": date, "ssn": ssn, "phone": phone, "card": card, "iban": iban}
    return "case " + " ".join(f"when {m} rlike {quoted('^(?:' + p + ')$')} then {make[kind]()}" for kind, p in PATTERNS) + f" else {m} end"


def kind_of(m: str) -> str:
    return "case " + " ".join(f"when {m} rlike {quoted('^(?:' + p + ')$')} then '{kind}'" for kind, p in PATTERNS) + " end"


def session_secret(spark: SparkSession) -> str:
    """The key of the session: as set, or drawn once."""
    return spark.conf.get(KEY_CONF, None) or _drawn.setdefault(session_key(spark), secrets.token_hex(16))


def pseudonymise(docs: DataFrame, key: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` rewritten, n_replaced (values changed) and kinds (their kinds, sorted).

    Without ``key`` the session's is used (``session_secret``).
    """
    key = key or session_secret(docs.sparkSession)
    body = F.col(f"`{text}`")
    some = body.rlike(SOME)
    found, between, new, changed = (spare(docs, n) for n in ("_found", "_between", "_new", "_changed"))
    df = docs.withColumn(found, F.when(some, F.regexp_extract_all(body, F.lit(ANY), F.lit(0))))
    df = df.withColumn(between, F.when(F.size(found) > 0, F.split(body, ANY, -1)))
    df = df.withColumn(new, F.when(F.size(found) > 0, F.expr(f"transform({found}, m -> {pseudonym('m', key)})")))
    pairs = F.zip_with(found, new, lambda a, b: F.struct(a.alias("old"), b.alias("new")))
    df = df.withColumn(changed, F.when(F.size(found) > 0, F.filter(pairs, lambda x: x["old"] != x["new"])))
    joined = F.array_join(F.zip_with(between, F.concat(new, F.array(F.lit(""))), lambda b, n: F.concat(b, n)), "")
    kinds = F.array_sort(F.array_distinct(F.expr(f"transform({changed}, x -> {kind_of('x.old')})")))
    added = {"n_replaced": F.coalesce(F.size(F.col(changed)), F.lit(0)).cast("long"), "kinds": F.coalesce(kinds, F.array().cast("array<string>"))}
    rewritten = F.when(F.size(changed) > 0, joined).otherwise(body)
    kept = [c for c in docs.columns if c.lower() not in added]
    return df.select(*[rewritten.alias(c) if c.lower() == text.lower() else df[f"`{c}`"] for c in kept], *[v.alias(n) for n, v in added.items()])


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs).select("doc_id", "text", "n_replaced", F.array_join("kinds", ",").alias("kinds"))
