"""Python literals as JSON text, in column expressions.

Texts written by ``repr`` or ``str`` of lists hold what JSON has not: strings in either
quote with Python's escapes, ``None``/``True``/``False``, tuples, sets, trailing
commas, parentheses, hexadecimal numbers, digits with underscores, comments.
:func:`with_json_text` reads them as a language: one regex cuts the text into tokens,
a fold over the tokens' kinds keeps the open brackets on a stack and tells tuples from
parentheses and sets from dicts, and every token is written out as JSON. A text that
breaks the grammar gives null; nothing is guessed.

The work is linear in the tokens but for the strings that the folds grow, which hold one
character a token. Texts that are JSON already are not tokenised, nor are plain ones: lists and
wrappers of flat tuples, lists and dicts whose strings hold no escape, quote or control character are written out
as JSON by a fixed number of regexes over the whole text (:func:`_plain`), with the same result.

A list, and a tuple inside a list or tuple, becomes a JSON array. Any other tuple becomes
``{"tuple": [...]}`` and a set ``{"set": [...]}``, so that a reader that asks for a list
does not take them for one. Not read (null, like broken text): bytes and complex
numbers, ``\\N{...}`` escapes, lone surrogates, tuples as dict keys, a bare ``1, 2``. A number
that is a dict key loses its sign.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import pinned, py_strip

_D = r"[0-9](?:_?[0-9])*+"
_STRING = (r"[uUrR]?(?:'''[^'\\]*+(?:(?:\\.|'(?!''))[^'\\]*+)*+'''|" + r'"""[^"\\]*+(?:(?:\\.|"(?!""))[^"\\]*+)*+"""|'
           r"'(?!'')[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|" + r'"(?!"")[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"|' + r"''(?!')|" + r'""(?!"))')
_NUMBER = (r"0[xX](?:_?[0-9a-fA-F])++|0[oO](?:_?[0-7])++|0[bB](?:_?[01])++|"
           rf"(?:{_D}\.?(?:{_D})?|\.{_D})(?:[eE][+-]?{_D})?")
TOKEN = rf"(?s){_STRING}|{_NUMBER}|[^\W\d]\w*|[\[\](){{}},:+-]|#[^\n]*"
_PIECE = r"(?s)\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|.)|[^\\]++"
_STRICT = {"allowSingleQuotes": "false"}

# Kinds of tokens next to each other that no literal has: unknown names; a value after a value (but
# strings, which Python joins); a comma or colon without a value before it; a sign before no number, or
# after a value; a colon before no value; a text that starts with a comma, a colon, or ends in either or a sign.
_BROKEN = (r"x|[snc\])}][nc\[({]|[nc\])}]s|[\[({,:-][,:]|[snc\])}]-|-(?!n)|:(?![sncx\[({-])|^[,:]|[,:-]$")


def is_json(text: Column) -> Column:
    """Whether a text is one whole JSON list or object: it is read as a member, with another after it that
    is not reached when the text breaks off or goes on."""
    whole = F.from_json(F.concat(F.lit('{"a":'), text, F.lit(',"z":0}')), "a string, z int", _STRICT)
    return text.rlike(r"^[\[{]") & whole["a"].isNotNull() & F.coalesce(whole["z"] == 0, F.lit(False))


def _kind(x: Column) -> Column:
    first = F.substring(x, 1, 1)
    return (F.when(x.rlike(r"(?s)['\"]$"), "s").when(x.rlike(r"^\.?[0-9]"), "n")
            .when(x.isin("None", "True", "False"), "c").when(first.isin(*"[](){},:"), first)
            .when(first.isin("+", "-"), "-").otherwise("x"))


def _starts() -> Column:
    return F.struct(F.lit("").alias("stack"), F.lit("").alias("codes"), F.lit("").alias("before"), F.lit(True).alias("ok"))


def _forward(a: Column, x: Column) -> Column:
    """Stack of open brackets ('t' a parenthesis with a comma, 'd' a brace with a colon); closers become
    T(uple), P(arenthesis), L(ist), D(ict), S(et)."""
    top, rest = F.substring(a["stack"], 1, 1), F.substring(a["stack"], 2, 1 << 30)
    stack = (F.when(x.isin("(", "[", "{"), F.concat(x, a["stack"])).when(x.isin(")", "]", "}"), rest)
             .when((x == ",") & (top == "("), F.concat(F.lit("t"), rest)).when((x == ":") & (top == "{"), F.concat(F.lit("d"), rest))
             .otherwise(a["stack"]))
    code = (F.when(x == ")", F.when((top == "t") | (a["before"] == "("), "T").otherwise("P")).when(x == "]", "L")
            .when(x == "}", F.when((top == "d") | (a["before"] == "{"), "D").otherwise("S")).otherwise(x))
    ok = (F.when(x == ")", top.isin("(", "t")).when(x == "]", top == "[").when(x == "}", top.isin("{", "d"))
          .when(x == ",", top != "").when(x == ":", top.isin("{", "d")).otherwise(True))
    return F.struct(stack.alias("stack"), F.concat(a["codes"], code).alias("codes"), x.alias("before"), (a["ok"] & ok).alias("ok"))


def _backward(a: Column, x: Column) -> Column:
    """From the last token on: every bracket gets the letter of its pair; a tuple outside lists and tuples is 'U'."""
    top = F.substring(a["stack"], 1, 1)
    closes = x.isin("T", "P", "L", "D", "S")
    mine = F.when((x == "T") & ~top.isin("L", "T", "P", "U", "S"), "U").otherwise(x)
    opens = x.isin("(", "[", "{")
    return F.struct(
        F.when(closes, F.concat(mine, a["stack"])).when(opens, F.substring(a["stack"], 2, 1 << 30)).otherwise(a["stack"]).alias("stack"),
        F.concat(F.when(closes, mine).when(opens, top).otherwise(x), a["codes"]).alias("codes"))


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, however often it is read."""
    return F.get(F.transform(F.array(value), then), 0)


_UNREAD = "\ufffe"  # stands for an escape that is not read; no text holds this noncharacter


def _unescaped(p: Column) -> Column:
    """The text of one piece of a string's body; null for an escape that is not read."""
    code = F.substring(p, 2, 1)
    octal = p.rlike(r"^\\[0-7]")
    digits = F.when(octal, F.conv(F.substring(p, 2, 3), 8, 16)).when(code.isin("x", "u", "U") & (F.length(p) > 2), F.substring(p, 3, 8))
    char = _let(F.lower(F.lpad(digits, 8, "0")), lambda h: F.when(
        ~h.rlike("^0000d[89a-f]") & (h <= "0010ffff"), F.decode(F.unhex(h), "UTF-32")))
    simple = F.translate(code, "abfnrtv", "\a\b\f\n\r\t\v")
    return (F.when(~p.startswith("\\"), p).when(octal | code.isin("x", "u", "U"), char).when(code == "N", F.lit(None))
            .when(code == "\n", "").when(code.isin(*"\\'\"abfnrtv"), simple).otherwise(p))


def _body(x: Column) -> Column:
    """A string token without its prefix and quotes."""
    return _let(F.regexp_replace(x, "^[uUrR]", ""), lambda v: F.when(
        v.rlike(r"(?s)^('''|\"\"\").*('''|\"\"\")$") & (F.length(v) >= 6), F.substring(v, F.lit(4), F.length(v) - 6))
        .otherwise(F.substring(v, F.lit(2), F.length(v) - 2)))


def _string(body: Column, raw: Column) -> Column:
    """The text of a string's body; null when an escape is not read."""
    parts = F.transform(F.regexp_extract_all(body, F.lit(_PIECE), F.lit(0)), _unescaped)
    read = _let(F.array_join(parts, "", _UNREAD), lambda v: F.when(~v.contains(_UNREAD), v))
    return F.when(raw | ~body.contains("\\"), body).otherwise(read)


def _number(x: Column) -> Column:
    """A number token as JSON has it; null for a decimal integer with leading zeros."""
    def written(v):
        based = (F.when(v.rlike("^0[xX]"), F.conv(F.substring(v, 3, 99), 16, 10)).when(v.rlike("^0[oO]"), F.conv(F.substring(v, 3, 99), 8, 10))
                 .otherwise(F.conv(F.substring(v, 3, 99), 2, 10)))
        short = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, r"^0+(?=[0-9])", ""), r"^\.", "0."), r"\.(?![0-9])", ".0")
        return F.when(v.rlike("^0[xXoObB]"), based).when(~v.rlike("^0+[1-9][0-9]*$"), short)
    return _let(F.regexp_replace(x, "_", ""), written)


def _quoted(text: Column) -> Column:
    return F.when(text.isNotNull(), F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", ""))


def _unit(x: Column, i: Column) -> Column:
    """A token, given its place, as JSON text."""
    kind, code, after = F.get("_kind", i), F.get("_code", i), F.get("_kind", i + 1)
    key = F.coalesce(after == ":", F.lit(False))

    def joined(v):  # neighbouring strings are one: their inner quotes go
        lo = F.when(F.get("_kind", i - 1) == "s", 2).otherwise(1)
        return F.substring(v, lo, F.length(v) - lo + 1 - F.when(after == "s", 1).otherwise(0))
    opened = F.when(code.isin("L", "T"), "[").when(code == "U", '{"tuple":[').when(code == "D", "{").when(code == "S", '{"set":[').otherwise("")
    closed = F.when(code.isin("L", "T"), "]").when(code.isin("U", "S"), "]}").when(code == "D", "}").otherwise("")
    number = _let(_number(x), lambda v: F.when(key, _quoted(v)).otherwise(v))
    return (F.when(kind == "s", _let(_quoted(F.get("_str", i)), joined)).when(kind == "n", number)
            .when(kind == ",", F.when(after.isin(")", "]", "}"), "").otherwise(",")).when(kind == ":", ":")
            .when(kind.isin("(", "[", "{"), opened).when(kind.isin(")", "]", "}"), closed)
            .when(kind == "c", F.when(key, F.concat(F.lit('"'), x, F.lit('"'))).when(x == "None", "null").otherwise(F.lower(x)))
            .when(kind == "-", F.when((x == "-") & ~F.coalesce(F.get("_kind", i + 2) == ":", F.lit(False)), "-").otherwise("")))


# --- plain texts: no tokens, no folds ---------------------------------------------------

_S = "\x01"  # stands for a string in the outline of a plain text
_PLAIN_STRING = r"[uUrR]?(?:'([^'\"\\\x00-\x1f]*+)'|\"([^\"\\\x00-\x1f]*+)\")"
_ANY_PLAIN = r"[uUrR]?(?:'[^'\"\\\x00-\x1f]*+'|\"[^\"\\\x00-\x1f]*+\")"
_ATOM = (r"(?<![\w.])(?:-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+|None|True|False)(?![\w.])")


def _outline(text: Column) -> Column:
    """A text with every string as one character and every other scalar as ``0``, without blanks, its flat
    tuples, dicts and lists as ``T``, ``D`` and ``L``; comments are gone already."""
    out = F.regexp_replace(F.regexp_replace(text, _ANY_PLAIN, _S), _ATOM, "0")
    out = F.regexp_replace(out, r"\s++", "")
    out = F.when(out.rlike(r"^[\[\](){},:0\x01]*+$"), out)
    out = F.regexp_replace(out, r"\((?:[0\x01],)++[0\x01]?+\)", "T")
    out = F.regexp_replace(out, r"\{(?:\x01:[0\x01],)*+(?:\x01:[0\x01])?+\}", "D")
    out = F.regexp_replace(out, r"\[(?:[0\x01],)*+[0\x01]?+\]", "L")
    return F.regexp_replace(out, r"\[(?:[0\x01TDL],)*+[0\x01TDL]?+\]", "L")


def _outside(text: Column, found: str, put: str) -> Column:
    """``found`` replaced wherever it is outside the strings, which are all in double quotes."""
    return F.regexp_replace(text, rf'\G((?:"[^"]*+"|(?!{found})[^"])*+)(?:{found})', "$1" + put)


def _plain(text: Column) -> Column:
    """The JSON of a plain text that is not JSON, else null; what it leaves goes through tokens and folds.

    Until its first quote that opens no plain string, a text is cut as by TOKEN; that quote stays in the outline,
    which has none, as strings next to each other, identifiers and unmatched brackets do."""
    bare = F.regexp_replace(text, rf"({_ANY_PLAIN})|#[^\n]*+", "$1 ")
    top = r"^(?:[LD]|\{(?:\x01:[0\x01LD],)*+(?:\x01:[0\x01LD])?+\})$"

    def written(v):
        out = F.regexp_replace(v, _PLAIN_STRING, '"$1$2"')
        out = F.regexp_replace(out, r'("[^"]*+")|\s++', "$1")
        for found, put in ((r"\(", "["), (r"\)", "]"), ("None", "null"), ("True", "true"), ("False", "false"), (r",(?=[\])}])", "")):
            out = _outside(out, found, put)
        return out
    return _let(F.when(~text.contains(_S), bare), lambda v: F.when(_outline(v).rlike(top), written(v)))


def with_json_text(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with column ``out``: the JSON of a text that is JSON or a Python literal (lists and dicts at the
    top), null for blank, broken or unread text."""
    rows = pinned(df, "_t", py_strip(F.col(text)))
    rows = pinned(rows, "_json", F.coalesce(is_json(F.col("_t")), F.lit(False)))
    rows = pinned(rows, "_flat", F.when(~F.col("_json") & F.col("_t").rlike(r"^[\[{]"), _plain(F.col("_t"))))
    rows = pinned(rows, "_tok", F.when(
        ~F.col("_json") & F.col("_flat").isNull() & (F.col("_t") != "") & (F.regexp_replace(F.col("_t"), rf"{TOKEN}|\s", "") == ""),
        F.filter(F.regexp_extract_all(F.col("_t"), F.lit(TOKEN), F.lit(0)), lambda x: ~x.startswith("#"))))
    rows = pinned(rows, "_kind", F.transform("_tok", _kind))
    rows = rows.withColumn("_kind", F.when(~F.array_join("_kind", "").rlike(_BROKEN), F.col("_kind")))
    rows = pinned(rows, "_fold", F.aggregate("_kind", _starts(), _forward))
    whole = F.col("_fold.ok") & (F.col("_fold.stack") == "") & F.col("_fold.codes").rlike("^[\\[({]")
    back = F.aggregate(F.split(F.reverse(F.col("_fold.codes")), ""), F.struct(F.lit("").alias("stack"), F.lit("").alias("codes")), _backward)
    rows = pinned(rows, "_code", F.when(whole, F.split(back["codes"], "")))

    bodies = F.transform("_tok", lambda x, i: F.when(F.get("_kind", i) == "s", _body(x)))
    rows = pinned(rows, "_body", F.when(F.col("_code").isNotNull(), bodies))
    rows = pinned(rows, "_str", F.transform("_body", lambda v, i: F.when(v.isNotNull(), _string(v, F.get("_tok", i).rlike("^[rR]")))))
    rows = pinned(rows, "_parts", F.when(F.col("_code").isNotNull(), F.transform("_tok", _unit)))
    folded = F.when(~F.exists("_parts", lambda p: p.isNull()), F.array_join("_parts", ""))
    rows = pinned(rows, "_lit", F.coalesce(F.col("_flat"), folded))
    json = F.when(F.col("_json"), F.col("_t")).otherwise(F.when(is_json(F.col("_lit")), F.col("_lit")))
    return pinned(rows, out, json).drop("_t", "_json", "_flat", "_lit", "_tok", "_kind", "_fold", "_code", "_body", "_str", "_parts")
