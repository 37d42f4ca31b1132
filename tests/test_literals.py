"""Python literals read in column expressions against ast.literal_eval."""
import ast
import json
import random

from pyspark.sql import functions as F

from panelkit.functions import literals as L
from panelkit.functions.literals import with_json_text
from panelkit.sources import payloads as PL

from conftest import rows

ODD = [
    "[('A', 1.5, None, 3)]", "[{'game': 'B', 'hours': None, 'x': True}]", "[('C', 1.5, 2, 3), ('D', 2.0, 1, True)]", "[('F', 1.0),]",
    "[('A')]", "[()]", "(('A',1),)", "{'rows': [('A',1),]}", "{'rows': (('A',1),)}", "['a' 'b' \"c\"]", "[007]", "[1,,2]", "[,]", "[1 2]", "[1, 2",
    "['it\\'s', \"say \\\"hi\\\"\", 'a\\nb', '\\x41\\u00e9\\U0001F600\\101\\0', 'tab\\there', 'back\\\\slash', 'q\\/x \\d']",
    "[1_000, 0x1F, 0o17, 0b11, 1., .5, 1e5, -3, +4, - 7, 00, 1_0.5e-1_0, 007.5]", "1, 2", "[(1,2]", "{1: 'a', None: 3}", "{1,2}", "[{1, 2}]", "{}",
    "[]", "[# c 'x\n 1, # d\n 2]", "['''tri'ple\n''', \"\"\"q\"uo\"\"\", '', \"\", '''''']", "[r'a\\nb', u'x']", "[x]", "[--1]", "[1+2]", "[[[(((1,2),),)]]]",
    "['a': 1]", "{'a': 1, 'b'}", "{'a' 'b': 1}", "['unterminated]", "[True, False, None, nan]", "['日本', 'é(x)[y]{z},:']", '[ ( ( "x" ) , ) ]',
    "[('a',),('b'),(('c','d'))]", "[1,]", "{'a':1,}", "{'a':}", "[:]", "[1:2]", "hello", "5", "'x'", '["ok", "json"]', "['line\\\ncont']", "[-'a']",
    "[1 -2]", "['\\x4']", "['\\'']", "[1.5.2]", "[1_]", "[_1]", "[0x]", "[Ünï]", "[]]", '{"a":1}]', "[1]],[2", "", "  ", "[\"it's\"]", "['\\N{DASH']",
]


def made(rnd, depth=0):
    k = rnd.randrange(9 if depth < 4 else 6)
    if k == 0:
        return rnd.choice([None, True, False])
    if k == 1:
        return rnd.randrange(-10**6, 10**6)
    if k == 2:
        return rnd.choice([1.5, -0.25, 1e20, 3.0, 1e-7])
    if k < 6:
        return "".join(rnd.choice("ab'\"\\\n\t ,:()[]{}#éñ日😀x\x00\x7f\x85") for _ in range(rnd.randrange(8)))
    several = [made(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    if k < 8:
        return several if k == 6 else tuple(several)
    return {rnd.choice(["game", "a'b", 'q"', "é"]): x for x in several}


def as_json(v, in_list=False):
    """What the module says a literal becomes."""
    if isinstance(v, (list, tuple)):
        items = [as_json(x, True) for x in v]
        return items if in_list or isinstance(v, list) else {"tuple": items}
    if isinstance(v, set):
        return {"set": sorted(v)}
    if isinstance(v, dict):
        return {str(k): as_json(x) for k, x in v.items()}
    return v


def expected(text):
    def literal(t):
        top = ast.parse(t, mode="eval").body
        if isinstance(top, ast.Tuple) and top.elts and top.elts[0].col_offset == top.col_offset:
            raise ValueError("a tuple without parentheses is not read")
        return as_json(ast.literal_eval(t))
    for read in (json.loads, literal):
        try:
            v = read(text.strip())
        except Exception:
            continue
        return v if isinstance(v, (list, dict)) else None
    return None


def test_literals_equal_literal_eval(spark):
    rnd, texts = random.Random(5), list(ODD)
    while len(texts) < 1200:
        v = made(rnd)
        if isinstance(v, (list, dict, tuple)):
            t = repr(v)
            i = rnd.randrange(len(t))
            texts += [t, t[:i] + rnd.choice(["", ",", "(", ")", "'", "\\", " ", "]"]) + t[i + rnd.randrange(2):]]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in with_json_text(df, "t", "j").select("id", "j").collect():
        got = None if r["j"] is None else json.loads(r["j"])
        assert got == expected(texts[r["id"]]), texts[r["id"]]


def test_what_is_not_read_gives_null(spark):
    df = spark.createDataFrame([(t,) for t in ("[b'x']", "[1j]", "1, 2", "['\\ud800']", "['\\N{DASH}']", "{(1, 2): 3}")], "t string")
    assert with_json_text(df, "t", "j").where("j is not null").count() == 0


def games(text):
    """The games of one text by the reference rules, in plain Python."""
    def number(v):
        try:
            return float(str(v).replace(",", "").strip()) if v is not None else None
        except ValueError:
            return None
    try:
        v = json.loads(text)
    except Exception:
        try:
            v = ast.literal_eval(text)
        except Exception:
            return []
    if isinstance(v, dict):
        v = v.get("rows") or v.get("data") or []
    out = []
    for pos, x in enumerate(v if isinstance(v, list) else [], 1):
        if isinstance(x, dict):
            got = (x.get("game") or x.get("title") or x.get("name"), x.get("hours") or x.get("streamtime"), x.get("avg_viewers") or x.get("avgviewers"))
        elif isinstance(x, (list, tuple)) and x:
            got = (x[0], x[1] if len(x) > 1 else None, x[3] if len(x) > 3 else None)
        else:
            continue
        name = "" if got[0] is None else str(got[0]).strip()
        if name:
            out.append((pos, name, number(got[1]), number(got[2])))
    return out


def test_games_of_literals(spark):
    texts = ["[('A', 1.5, None, 3)]", "[{'game': 'B', 'hours': None, 'avg_viewers': '1,200'}]", "[('C', 1.5, 2, 3), ('D', 2.0, 1, True)]", "[('F', 1.0),]",
             "{'rows': [], 'data': [('G',), ['H', '2'], {'title': 'It\\'s', 'streamtime': 3}, 'text', 5, None, ()]}", "{'rows': (('I', 1),)}", "(('J', 1),)",
             "[(None, 1), ('', 2), (' K ', 0x10)]", "[{'game': 'L'}, {1, 2}, ({'game': 'M'}), (('N', 4))]", "[('O', 1.0)", '{"rows":[["P",1,2,3]],"data":[["Q"]]}', "{}"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = rows(PL.parse_games_text(df, "t", ["id"]), "id", "pos", "game", "hours", "avg_viewers")
    assert got == sorted((i, *g) for i, t in enumerate(texts) for g in games(t))
    forms = rows(PL.games_text_forms(df.union(spark.createDataFrame([(99, None), (98, " ")], df.schema)), "t"), "form", "texts")
    assert forms == [("blank", 2), ("json", 2), ("literal", 7), ("not_list", 2), ("unparsed", 1)]


def test_long_text_and_no_python(spark):
    text = "[" + ", ".join(f"('game {i}', {i}.5, None, {i},)" for i in range(3000)) + ",]"
    df = spark.range(1).select("id", F.lit(text).alias("t"))
    out = PL.parse_games_text(df, "t", ["id"])
    assert out.agg(F.count(F.lit(1)), F.sum("hours")).first() == (3000, sum(i + 0.5 for i in range(3000)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


PLAIN = ["[('Go', 1.5, -2, None, True,), ('#x(,)', 0, 1e5, False, 'None'),]", "{'rows': [], 'data': [  # it's (one\n ('a', 1),],}",
         """[{'title': None, "game": "Brand#13", u'hours': 2.0, 'live': False,}, [1, 'b'], 'c',]""", "{'a': {'b': 1}, 'c': [None,],}", "{'a': 'None,)'}"]
OTHER = ["['it\\'s', 1,]", "['''a''', 1,]", "['a' 'b',]", "[('a')]", "[()]", "['a, 1]", "[1 2,]", "[007,]", "[0x1F,]", "[- 5,]", "['\"',]", "[x,]", "[s,]",
         "[\x01,]", "[\"it's\", \"# x\",]", "[None.,]", "{None: 1,}", "[{'a': (1, 2)},]", "['''# x\n''',]", "[1,,]", "[,]", "(1, 2)", "[T,]", "[b'a',]",
         "['é', {'k': [1,],},]", "[1.,]", "[1_0,]", "[--1,]", "['\t',]", "[True False,]", "[('a',) 'b']", "['\x01', None]"]


def test_plain_texts_are_read_as_by_folds(spark, monkeypatch):
    """Plain texts need no tokens; every text has the JSON that tokens and folds give it."""
    df = spark.createDataFrame([(t,) for t in PLAIN + OTHER + ["[" + "('ab', 1.5, None), " * 20000 + "]"]], "t string")
    fast = {r["t"]: (r["p"], r["j"]) for r in L.with_json_text(df, "t", "j").withColumn("p", L._plain(F.col("t"))).collect()}
    assert all(fast[t][0] is not None for t in PLAIN)
    assert all(p is None or p == j for p, j in fast.values())
    monkeypatch.setattr(L, "_plain", lambda text: F.lit(None).cast("string"))
    short = df.where(F.length("t") < 1000)
    assert {r["t"]: r["j"] for r in L.with_json_text(short, "t", "j").collect()} == {t: j for t, (_, j) in fast.items() if len(t) < 1000}
