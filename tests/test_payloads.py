"""Landed JSON payloads: envelopes, aliases, junk (FIXTURES-style rows)."""
import pytest

from panelkit.sources import payloads as PL

from conftest import rows

ITEM = ('{"id":101,"rownum":1,"displayname":"Alpha","url":"/alpha","avgviewers":900,"maxviewers":2500,'
        '"viewminutes":54000,"streamedminutes":6000,"followers":1000,"followersgained":-5,"language":"en"}')


def pages(spark, payloads):
    return spark.createDataFrame([("2024march", i, 0, p) for i, p in enumerate(payloads)],
                                 "month_key string, page_seq bigint, offset bigint, payload string")


def test_leaderboard_envelopes(spark):
    ps = [f'{{"data":[{ITEM}]}}', f'{{"aaData":[{ITEM}]}}', f'{{"rows":[{ITEM}]}}', f'{{"results":[{ITEM}]}}',
          f'{{"items":[{ITEM}]}}', f'[{ITEM}]', f'{{"data":{{"x":1}},"rows":[{ITEM}]}}']
    got = PL.read_leaderboard(pages(spark, ps)).collect()
    assert len(got) == 7
    r = got[0]
    assert (r["channel_id"], r["rank"], r["average_viewers"], r["hours_watched"], r["hours_streamed"]) == \
        (101, 1, 900.0, 900.0, 100.0)
    assert (r["followers"], r["followers_gained"], r["peak_viewers"], r["display_name"]) == (1000, -5, 2500, "Alpha")


def test_leaderboard_junk(spark):
    ps = ['{"data":["text", null, {"id":0,"channelId":7,"rank":3}, {"id":5,"rownum":0}, {"id":6},'
          ' {"id":8,"position":2}]}', '{"data":[{"id":1,', 'not json', '[]']
    got = rows(PL.read_leaderboard(pages(spark, ps)), "channel_id", "rank", "hours_watched")
    assert got == [(7, 3, None), (8, 2, None)]


def test_games_payload_layouts(spark):
    p = ('{"recordsTotal":2,"data":[{"gamesplayed":"Chess|chess|http://img","streamtime":90,"viewtime":9000,'
         '"avgviewers":100,"maxviewers":300},{"gamesplayed":"","streamtime":null,"viewtime":null,'
         '"avgviewers":null,"maxviewers":null},{"title":"Go","streamtime":"1,200"}]}')
    df = spark.createDataFrame([(1, "m", 0, p)], "channel_id bigint, month_key string, page bigint, payload string")
    e = rows(PL.read_games(df), "idx", "game", "hours", "peak_viewers", "avg_viewers", "view_minutes")
    assert e == [(1, "Chess", 1.5, 300, 100.0, 9000.0), (2, None, 0.0, None, None, None), (3, "Go", 20.0, None, None, None)]
    i = rows(PL.read_games_ingest(df), "idx", "game", "hours", "avg_viewers", "peak_viewers", "hours_watched")
    assert i[:2] == [(1, "Chess", 1.5, 100, 300, 150.0), (2, "Unknown", 0.0, 0, 0, 0.0)]
    c = PL.games_pages_complete(df).first()
    assert (c["rows"], c["records_total"], c["complete"]) == (3, 2, True)
    short = spark.createDataFrame([(1, "m", 0, '{"recordsTotal":150,"data":[{"game":"A"}]}')],
                                  "channel_id bigint, month_key string, page bigint, payload string")
    assert PL.games_pages_complete(short).first()["complete"] is False


def test_channel_payload(spark):
    df = spark.createDataFrame([
        (1, '{"result":{"avgViewers":10,"followerCount":"20"}}'),
        (2, '[{"a":1},{"b":2}]'),
        (3, '{"data":{"average_viewers":null,"avg_viewers":5,"lang":"en"}}'),
        (4, '[{"peak_viewers":"7"}]'),
        (5, '{"nothing":1}'),
    ], "channel_id bigint, payload string")
    got = {r["channel_id"]: r for r in PL.read_channel(df).collect()}
    assert (got[1]["average_viewers"], got[1]["followers"]) == (10.0, 20)
    assert 2 not in got and 5 not in got
    assert got[3]["average_viewers"] is None and got[3]["language"] == "en"   # first present key wins
    assert got[4]["peak_viewers"] == 7


def test_users_payload(spark):
    df = spark.createDataFrame([(0, '{"data":[{"login":"Alpha","created_at":"2016-05-02T00:00:00Z"},{"login":""}]}')],
                               "batch_id bigint, payload string")
    assert rows(PL.read_users(df)) == [("alpha", "2016-05-02T00:00:00Z")]


def test_games_text(spark):
    texts = [
        '[["Chess",1.5,300,100.0,9000.0],[null,2,0,0,0]]',
        '[{"game":"Chess","hours":1.5,"avg_viewers":0}]',
        '{"rows":[["Chess",1,2,3.5,4]]}',
        "[['Chess',1.5]]",
        '', 'junk', None, '5',
        '[{"title":"Café \\"A|B\\"","streamtime":2}]',
        "[('Go (2019)', 2.5, 1, 4.0), ('Chess', 1)]",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = rows(PL.parse_games_text(df, "t", ["id"]), "id", "game", "hours", "avg_viewers")
    assert got == [(0, "Chess", 1.5, 100.0), (1, "Chess", 1.5, None), (2, "Chess", 1.0, 3.5),
                   (3, "Chess", 1.5, None), (8, 'Café "A|B"', 2.0, None),
                   (9, "Chess", 1.0, None), (9, "Go (2019)", 2.5, 4.0)]


def test_games_page_landed_twice(spark):
    page = '{"recordsTotal":4,"data":[{"gamesplayed":"A","streamtime":60},{"gamesplayed":"B","streamtime":60}]}'
    newer = page.replace('"A"', '"C"')
    df = spark.createDataFrame([(1, "2024march", 0, page, 1), (1, "2024march", 0, newer, 2)],
                               "channel_id bigint, month_key string, page bigint, payload string, landed_at bigint")
    assert sorted(r["game"] for r in PL.read_games(df).collect()) == ["B", "C"]
    assert PL.games_pages_complete(df).first()["complete"] is False
    # two versions without a landing time have no order; the same one landed twice needs none
    with pytest.raises(Exception, match="no landed_at"):
        PL.read_games(df.drop("landed_at")).collect()
    same = df.where("landed_at = 1").drop("landed_at")
    assert PL.read_games(same.union(same)).count() == 2


def test_games_page_gaps(spark):
    def page(pair, n, total, at=1):
        return (pair, "2024march", n, f'{{"recordsTotal":{total},"data":[{{"gamesplayed":"A"}}]}}', at)
    df = spark.createDataFrame([page(1, 0, 250), page(1, 2, 250), page(2, 3, 700), page(2, 4, 700), page(3, 0, 100), page(4, 1, 50, 1), page(4, 0, 150, 2),
                                page(5, 0, 400, 1), page(5, 0, 90, 2), (6, "2024march", 0, "not json", 1)],
                               "channel_id bigint, month_key string, page bigint, payload string, landed_at bigint")
    assert rows(PL.games_page_gaps(df, 100), "channel_id", "first_missing", "last_missing") == [(1, 1, 1), (2, 0, 2), (2, 5, 6)]
