"""Landed JSON payloads: building pages from tables, and reading them back.

Readers turn a column of JSON text into typed rows with ``from_json`` +
``explode``; nothing is parsed in Python. Writers (``land_*``) produce such
pages from the landed tables with ``to_json`` over groups whose size is
bounded by construction (a page of ranks, the games of one channel-month,
a batch of 100 logins), so no group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.literals import with_json_text
from ..operators.games import pie_tops

# Envelope keys searched for the first list, in order (fixed values).
ENVELOPE_KEYS = ["data", "aaData", "rows", "results", "items"]
# Leaderboard item aliases (fixed values).
ID_KEYS = ["id", "channelId", "channel_id"]
RANK_KEYS = ["rownum", "rank", "position", "rank_position"]
# Channel payload wrappers and field aliases (fixed values).
CHANNEL_WRAPPERS = ["data", "results", "result", "channel", "items"]
CHANNEL_FIELDS = {
    "average_viewers": ["average_viewers", "avg_viewers", "avgViewers"],
    "hours_watched": ["hours_watched", "hoursWatched", "watch_time"],
    "hours_streamed": ["hours_streamed", "hoursStreamed", "stream_time", "streamTime"],
    "followers": ["followers", "follower_count", "followerCount"],
    "followers_gained": ["followers_gained", "followersGained", "new_followers"],
    "peak_viewers": ["peak_viewers", "peakViewers"],
    "top_game": ["top_game", "topGame", "game"],
    "top_game_hours": ["top_game_hours", "topGameHours"],
    "top_game_pct": ["top_game_pct", "topGamePct"],
    "game_count": ["game_count", "gameCount"],
    "is_variety_streamer": ["is_variety_streamer", "isVarietyStreamer"],
    "language": ["language", "lang"],
    "created": ["created", "created_at", "createdAt"],
    "mature": ["mature"],
    "peak_viewer_rank": ["peak_viewer_rank", "peakViewerRank"],
    "avg_viewer_rank": ["avg_viewer_rank", "avgViewerRank"],
    "follower_rank": ["follower_rank", "followerRank"],
    "follower_gain_rank": ["follower_gain_rank", "followerGainRank"],
}
CHANNEL_TEXT = ("top_game", "language", "created", "mature")
CHANNEL_FLOATS = ("average_viewers", "hours_watched", "hours_streamed", "top_game_hours", "top_game_pct")
# Games item: name fields in order of preference (fixed values).
GAME_NAME_KEYS = ["gamesplayed", "game", "games", "title"]

_ENVELOPE = "struct<" + ",".join(f"{k}:array<string>" for k in ENVELOPE_KEYS) + ">"


def envelope_items(payload: Column) -> Column:
    """JSON text -> array of item texts: a bare list, or the first envelope key
    holding a list (keys holding objects are skipped). Text that does not begin
    as a list is not read as one: a failed parse costs more than a read page."""
    env = F.from_json(payload, _ENVELOPE)
    bare = F.when(payload.rlike(r"\A[ \t\r\n]*\["), F.from_json(payload, "array<string>"))
    return F.coalesce(bare, *[env[k] for k in ENVELOPE_KEYS])


def _truthy(v: Column) -> Column:
    """Python truthiness of a JSON scalar kept as text: null, '', 0 are false."""
    return F.when(v.isNull() | (v == "") | (v.rlike(r"^-?0+(\.0+)?$")) | (v == "false"), None).otherwise(v)


def py_or(m: Column, keys: list[str]) -> Column:
    """``d.get(k1) or d.get(k2) or ...`` over a map<string,string>."""
    return F.coalesce(*[_truthy(m[k]) for k in keys])


def first_present(m: Column, keys: list[str]) -> Column:
    """Value of the first key *present* in the map, even when its value is null."""
    expr = None
    for k in keys:
        cond = F.map_contains_key(m, k)
        expr = F.when(cond, m[k]) if expr is None else expr.when(cond, m[k])
    return expr


# --- leaderboard pages --------------------------------------------------------

def land_leaderboard_pages(live: DataFrame) -> DataFrame:
    """Live rows -> one JSON page per (month_key, page_seq); envelopes vary
    by page (data / aaData / bare list)."""
    item = F.struct(
        F.col("channel_id").alias("id"), F.col("rank").alias("rownum"),
        F.col("display_name").alias("displayname"), F.col("channel_slug").alias("url"),
        F.col("average_viewers").alias("avgviewers"), F.col("peak_viewers").alias("maxviewers"),
        (F.col("hours_watched") * 60.0).alias("viewminutes"),
        (F.col("hours_streamed") * 60.0).alias("streamedminutes"),
        F.col("followers").alias("followers"), F.col("followers_gained").alias("followersgained"),
        F.col("language").alias("language"),
    )
    pages = live.groupBy("month_key", "page_seq").agg(F.collect_list(F.struct("row_pos", item.alias("it"))).alias("r"))
    arr = F.transform(F.array_sort("r"), lambda x: x["it"])
    kind = F.col("page_seq") % 3
    payload = (F.when(kind == 0, F.to_json(F.struct(arr.alias("data"))))
               .when(kind == 1, F.to_json(F.struct(arr.alias("aaData"))))
               .otherwise(F.to_json(arr)))
    return pages.select("month_key", "page_seq", payload.alias("payload"))


def read_leaderboard(pages: DataFrame) -> DataFrame:
    """Landed pages -> (month_key, page_seq, row_pos, channel_id, rank, metrics).

    Items that are not objects are skipped; id and rank take the first truthy
    alias; rows need id > 0 and rank > 0. Metrics are in panel units
    (minutes / 60, unrounded)."""
    items = pages.select("month_key", "page_seq", F.posexplode(envelope_items(F.col("payload"))).alias("pos", "item"))
    m = F.from_json(F.col("item"), "map<string,string>")
    rows = items.select("month_key", "page_seq", (F.col("pos") + 1).cast("bigint").alias("row_pos"), m.alias("m")) \
                .where(F.col("m").isNotNull())
    cid = S.safe_int(py_or(F.col("m"), ID_KEYS), strip_commas=False)
    rank = S.safe_int(py_or(F.col("m"), RANK_KEYS), strip_commas=False)
    vm = S.clean_number(F.col("m")["viewminutes"], strip_commas=False)
    sm = S.clean_number(F.col("m")["streamedminutes"], strip_commas=False)
    out = rows.select(
        "month_key", "page_seq", "row_pos",
        cid.alias("channel_id"), rank.alias("rank"),
        S.clean_number(F.col("m")["avgviewers"], strip_commas=False).alias("average_viewers"),
        (vm / 60.0).alias("hours_watched"), (sm / 60.0).alias("hours_streamed"),
        S.safe_int(F.col("m")["followers"], strip_commas=False).alias("followers"),
        S.safe_int(F.col("m")["followersgained"], strip_commas=False).alias("followers_gained"),
        S.safe_int(F.col("m")["maxviewers"], strip_commas=False).alias("peak_viewers"),
        F.col("m")["language"].alias("language"),
        py_or(F.col("m"), ["displayname", "display_name"]).alias("display_name"),
        py_or(F.col("m"), ["url", "channel_slug"]).alias("channel_slug"),
    )
    return out.where((F.col("channel_id") > 0) & (F.col("rank") > 0))


# --- games pages --------------------------------------------------------------

def land_games_pages(games: DataFrame, page_size: int = 10) -> DataFrame:
    """Games rows -> JSON table pages per (channel, month, page) with recordsTotal."""
    g = games.withColumn("page", F.floor((F.col("pos") - 1) / page_size).cast("bigint"))
    total = F.count(F.lit(1)).over(Window.partitionBy("channel_id", "month_key"))
    g = g.withColumn("records_total", total)
    item = F.struct(
        F.concat(F.col("game"), F.lit("|"), F.lower(F.regexp_replace("game", "#", "")), F.lit("|http://img"))
         .alias("gamesplayed"),
        (F.col("hours") * 60.0).alias("streamtime"), F.col("view_minutes").alias("viewtime"),
        F.col("avg_viewers").alias("avgviewers"), F.col("peak_viewers").alias("maxviewers"),
    )
    pages = g.groupBy("channel_id", "month_key", "page").agg(
        F.max("records_total").alias("recordsTotal"),
        F.collect_list(F.struct("pos", item.alias("it"))).alias("r"))
    arr = F.sort_array("r")["it"]
    return pages.select("channel_id", "month_key", "page",
                        F.to_json(F.struct("recordsTotal", arr.alias("data"))).alias("payload"))


def newest_pages(pages: DataFrame) -> DataFrame:
    """A page landed more than once counts once: the newest by ``landed_at``. Pages without that column may be landed
    again with the same payload; two different ones have no order and raise."""
    if "landed_at" in pages.columns:
        newest = F.max_by("payload", "landed_at")
    else:
        message = F.lit("a page was landed with different payloads and no landed_at to order them")
        newest = F.when(F.min("payload") != F.max("payload"), F.raise_error(message).cast("string")).otherwise(F.max("payload"))
    return pages.groupBy("channel_id", "month_key", "page").agg(newest.alias("payload"))


def games_page_gaps(pages: DataFrame, page_size: int = 100) -> DataFrame:
    """Runs of pages that have not landed: (channel_id, month_key, first_missing, last_missing).

    Of a channel and month, the pages 0 to the last one that its reported total needs are expected (the greatest
    total of its newest versions); the gaps between the landed page numbers, and after the last, are the runs. The
    page numbers of one channel and month are as many as its games need; a pair of which nothing landed has no row."""
    landed = newest_pages(pages).select("channel_id", "month_key", "page", F.get_json_object("payload", "$.recordsTotal").try_cast("bigint").alias("total"))
    of_pair = landed.groupBy("channel_id", "month_key").agg(F.sort_array(F.collect_set("page")).alias("_pages"), F.max("total").alias("_total"))
    expected = F.ceil(F.coalesce(F.col("_total"), F.lit(0)) / page_size).cast("bigint")
    stops = S.pinned(of_pair, "_stops", F.concat(F.array(F.lit(-1).cast("bigint")), F.col("_pages"), F.array(expected)))
    gaps = F.transform(F.sequence(F.lit(1), F.size("_stops") - 1), lambda i: F.struct(
        (F.get("_stops", i - 1) + 1).alias("first_missing"), (F.get("_stops", i) - 1).alias("last_missing")))
    return (stops.select("channel_id", "month_key", F.explode(gaps).alias("g")).select("channel_id", "month_key", "g.*")
            .where("first_missing <= last_missing"))


def _games_items(pages: DataFrame) -> DataFrame:
    """Items of the landed pages, each page once (:func:`newest_pages`) and each item parsed once."""
    total = F.get_json_object("payload", "$.recordsTotal").try_cast("bigint")
    pages = S.pinned(newest_pages(pages), "records_total", total)  # once per page, not per item
    items = pages.select("channel_id", "month_key", "page", "records_total", F.posexplode(envelope_items(F.col("payload"))).alias("idx", "item"))
    return S.pinned(items, "m", F.from_json("item", "map<string,string>")).where(F.col("m").isNotNull())


def read_games(pages: DataFrame) -> DataFrame:
    """Games pages -> (channel_id, month_key, page, idx, game, hours, peak_viewers,
    avg_viewers, view_minutes): name = text before the first '|' of the first
    non-blank name field; hours = minutes / 60 to 2 decimals (0 when missing)."""
    m = F.col("m")
    it = S.pinned(_games_items(pages), "_raw", S.first_nonempty(*[m[k] for k in GAME_NAME_KEYS]))
    game = F.when(F.col("_raw") != "", S.py_strip(F.split_part("_raw", F.lit("|"), F.lit(1))))
    return it.select(
        "channel_id", "month_key", "page", (F.col("idx") + 1).cast("bigint").alias("idx"),
        game.alias("game"),
        S.round_dp(F.coalesce(S.clean_number(m["streamtime"]), F.lit(0.0)) / 60.0, 2).alias("hours"),
        S.safe_int(m["maxviewers"]).alias("peak_viewers"),
        S.clean_number(m["avgviewers"]).alias("avg_viewers"),
        S.clean_number(m["viewtime"]).alias("view_minutes"),
    )


def read_games_ingest(pages: DataFrame) -> DataFrame:
    """Ingest layout: blank name -> 'Unknown', missing numbers -> 0, viewers
    truncated to integers, view minutes -> hours watched (2 dp)."""
    m = F.col("m")
    it = S.pinned(_games_items(pages), "_raw", F.coalesce(_truthy(m["gamesplayed"]), F.lit("")))
    game = F.when(F.col("_raw") != "", S.py_strip(F.split_part("_raw", F.lit("|"), F.lit(1)))).otherwise(F.lit("Unknown"))

    def num(k):
        return F.coalesce(S.clean_number(_truthy(m[k]), strip_commas=False), F.lit(0.0))
    return it.select(
        "channel_id", "month_key", "page", (F.col("idx") + 1).cast("bigint").alias("idx"),
        game.alias("game"), S.round_dp(num("streamtime") / 60.0, 2).alias("hours"),
        num("avgviewers").cast("bigint").alias("avg_viewers"),
        num("maxviewers").cast("bigint").alias("peak_viewers"),
        S.round_dp(num("viewtime") / 60.0, 2).alias("hours_watched"),
    )


def games_pages_complete(pages: DataFrame) -> DataFrame:
    """Per (channel, month): pages and rows landed vs the reported total."""
    it = _games_items(pages)
    return it.groupBy("channel_id", "month_key").agg(
        F.count_distinct("page").alias("pages"), F.count(F.lit(1)).alias("rows"),
        F.max("records_total").alias("records_total"),
    ).withColumn("complete", F.col("rows") >= F.coalesce(F.col("records_total"), F.lit(0)))


# --- pies -------------------------------------------------------------------

def land_pies(games: DataFrame) -> DataFrame:
    """Games rows -> one pie per (channel, month): labels sorted by name, values = hours."""
    pies = games.groupBy("channel_id", "month_key").agg(
        F.array_sort(F.collect_list(F.struct("game", "hours"))).alias("p"))
    body = F.struct(F.struct(
        F.transform("p", lambda x: x["game"]).alias("labels"),
        F.array(F.struct(F.transform("p", lambda x: x["hours"]).alias("data"))).alias("datasets"),
    ).alias("data"))
    return pies.select("channel_id", "month_key", F.to_json(body).alias("payload"))


_PIE = "struct<data:struct<labels:array<string>,datasets:array<struct<data:array<double>>>>>"


def _slices(payload: Column) -> Column:
    """Pie JSON -> array<struct<label, value>>; null when malformed."""
    body = F.from_json(payload, _PIE)["data"]
    z = F.arrays_zip(body["labels"].alias("label"), body["datasets"][0]["data"].alias("value"))
    return F.filter(z, lambda x: x["label"].isNotNull())


def read_pies(pies: DataFrame) -> DataFrame:
    """Pie JSON -> (keys, pos, label, value), pos counted over the labelled
    slices; malformed -> no rows."""
    return pies.select("channel_id", "month_key", F.posexplode(_slices(F.col("payload"))).alias("pos", "lv")).select(
        "channel_id", "month_key", (F.col("pos") + 1).cast("bigint").alias("pos"),
        F.col("lv.label").alias("label"), F.col("lv.value").alias("value"))


def read_pie_tops(pies: DataFrame, top: int = 5) -> DataFrame:
    """Pie JSON -> (keys, top): the ``top`` labels and the rest as one, worked
    out within the row; malformed -> empty list."""
    rows = S.pinned(pies.select("channel_id", "month_key", "payload"), "_slices", _slices(F.col("payload")))
    none = F.array().cast("array<struct<label:string,value:double>>")
    return pie_tops(rows, "_slices", "top", top).select(
        "channel_id", "month_key", F.coalesce(F.col("top"), none).alias("top"))


# --- channel and users payloads ----------------------------------------------

def read_channel(payloads: DataFrame, key: str = "channel_id") -> DataFrame:
    """Channel payload -> metrics. A one-item list is unwrapped, longer lists
    give nothing; the first wrapper holding an object is used; for every field
    the first *present* alias wins, even when its value is null."""
    p = F.col("payload")
    as_list = F.from_json(p, "array<string>")
    obj_text = F.when(as_list.isNull(), p).when(F.size(as_list) == 1, as_list[0])
    # the outer and the inner object are each parsed once per payload
    rows = S.pinned(payloads.select(key, "payload"), "_top", F.from_json(obj_text, "map<string,string>"))
    top, inner = F.col("_top"), None
    for w in CHANNEL_WRAPPERS:
        cand = F.from_json(top[w], "map<string,string>")
        inner = F.when(cand.isNotNull(), cand) if inner is None else inner.when(cand.isNotNull(), cand)
    df = S.pinned(rows, "m", inner.otherwise(top))
    fields = {}
    for f, keys in CHANNEL_FIELDS.items():
        v = first_present(F.col("m"), keys)
        if f in CHANNEL_FLOATS:
            v = S.clean_number(v, strip_commas=False)
        elif f not in CHANNEL_TEXT:
            v = S.safe_int(v, strip_commas=False)
        fields[f] = v
    out = df.select(key, *[v.alias(f) for f, v in fields.items()])
    return out.where(S.any_not_null(*fields.keys()))


def land_users(users: DataFrame, batch: int = 100) -> DataFrame:
    """(login, created_at, batch_id) -> one {"data": [...]} payload per batch."""
    g = users.groupBy("batch_id").agg(F.collect_list(F.struct("login", "created_at")).alias("data"))
    return g.select("batch_id", F.to_json(F.struct("data")).alias("payload"))


def read_users(payloads: DataFrame) -> DataFrame:
    """Users payloads -> (login lower, created_at) for items with a login."""
    it = payloads.select(F.explode(envelope_items(F.col("payload"))).alias("item"))
    m = F.from_json("item", "map<string,string>")
    return it.select(F.lower(m["login"]).alias("login"), m["created_at"].alias("created_at")) \
             .where(F.col("login").isNotNull() & (F.col("login") != ""))


# --- free-form games text (analysis side) -----------------------------------

def _games_list(j: Column) -> Column:
    """JSON -> the text of its list: itself, or the first of ``rows`` and ``data`` that is not empty."""
    def member(key):
        v = F.get_json_object(j, f"$.{key}")
        return F.when(~v.isin("[]", "{}", "0", "0.0", "false", ""), v)
    return F.when(j.startswith("["), j).otherwise(F.coalesce(member("rows"), member("data")))


def parse_games_text(df: DataFrame, col: str, keep: list[str], dict_zero_as_missing: bool = True) -> DataFrame:
    """Lenient games text -> (keep..., pos, game, hours, avg_viewers).

    Accepts a list or a {rows|data: list} wrapper, written as JSON or as a Python
    literal (:mod:`panelkit.functions.literals`); each item may be an array or
    tuple (game, hours, _, avg, ...) or an object (game|title|name,
    hours|streamtime, avg_viewers|avgviewers). Text that is neither gives no rows;
    :func:`games_text_forms` counts it.
    With ``dict_zero_as_missing`` an object's 0 falls through to the next
    alias (and so to missing), like a Python ``or`` chain."""
    texts = with_json_text(df.select(*keep, F.col(col).alias("_text")), "_text", "_j")
    items = texts.select(*keep, F.posexplode(F.from_json(_games_list(F.col("_j")), "array<string>")).alias("p0", "item"))
    # an item is parsed once, as what it starts like
    is_arr = F.col("item").startswith("[")
    items = S.pinned(items, "_arr", F.when(is_arr, F.from_json("item", "array<string>")))
    items = S.pinned(items, "_obj", F.when(~is_arr, F.from_json("item", "map<string,string>")))
    arr, obj = F.col("_arr"), F.col("_obj")
    pick = py_or if dict_zero_as_missing else (lambda m, ks: F.coalesce(*[m[k] for k in ks]))
    game = F.when(is_arr, F.get(arr, 0)).otherwise(pick(obj, ["game", "title", "name"]))
    hours = F.when(is_arr, F.try_element_at(arr, F.lit(2))).otherwise(pick(obj, ["hours", "streamtime"]))
    avg = F.when(is_arr, F.try_element_at(arr, F.lit(4))).otherwise(pick(obj, ["avg_viewers", "avgviewers"]))
    out = items.where(F.col("item").isNotNull() & (is_arr | obj.isNotNull())).select(
        *keep, (F.col("p0") + 1).cast("bigint").alias("pos"), S.safe_str(game).alias("game"),
        S.clean_number(hours).alias("hours"), S.clean_number(avg).alias("avg_viewers"))
    return out.where(F.col("game") != "")


def games_text_forms(df: DataFrame, col: str, keys: list[str] | None = None) -> DataFrame:
    """Texts per form (and ``keys``): ``blank``, ``json``, ``literal`` (Python), ``not_list`` (read, but neither a
    list nor a wrapper of one) and ``unparsed``, whose games are in no report."""
    keys = keys or []
    texts = with_json_text(df.select(*keys, F.col(col).alias("_text")), "_text", "_j")
    j, t = F.col("_j"), S.py_strip("_text")
    form = (F.when(F.coalesce(t, F.lit("")) == "", "blank").when(j.isNull(), "unparsed")
            .when(t.startswith("(") & j.startswith('{"tuple":'), "not_list")
            .when(F.from_json(F.coalesce(_games_list(j), F.lit("[]")), "array<string>").isNull(), "not_list")
            .when(j == t, "json").otherwise("literal"))
    return texts.groupBy(*keys, form.alias("form")).agg(F.count(F.lit(1)).alias("texts"))
