import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from basketry.llm import chat, oracles, queries, url_templates

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def python_plan(plan):
    return re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- chat
def test_op8_against_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    turns, loss, n = defaultdict(str), defaultdict(str), Counter()
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        turns[conv] += f"{role}\n{text or ''}\n"
        loss[conv] += (text or "") if role == "assistant" else ""
        n[conv] += 1
    df = queries.op8_chat_windows(spark, SF)
    assert not python_plan(df._jdf.queryExecution().executedPlan().toString())
    got = {r.conv_id: r for r in df.collect()}
    assert set(got) == set(turns)
    for c, r in got.items():
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (n[c], sha(turns[c]), len(loss[c]), sha(loss[c]))
        assert r.formatted_chars > len(turns[c])


def brute_windows(turns, budget, history, size):
    """turns: (role, text) in order -> list of (repeated turns, new turns)."""
    system = next((t for t in turns if t[0] == "system"), None)
    quarter = budget // 4
    room = max(1, budget - (size(system[1]) if system else 0) - quarter)
    starts, base, total = [], 0, 0
    for i, t in enumerate(turns):
        if not starts or total + size(t[1]) - base > room:
            starts.append(i)
            base = total
        total += size(t[1])
    out = []
    for a, b in zip(starts, [*starts[1:], len(turns)]):
        back, used = [], 0
        for t in turns[max(0, a - history) : a][::-1]:
            if used + size(t[1]) > quarter:
                break
            used += size(t[1])
            back.insert(0, t)
        if system and system not in back + turns[a:b]:
            back.insert(0, system)
        out.append((back, turns[a:b]))
    return out


def tokens(text):
    return len(re.findall(r"[^\W_]+|[^\w\s]|_", text)) + 3


@pytest.mark.parametrize("budget", [8, 64, 300, 100_000])
def test_windows_against_brute_force(spark, budget):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    convs = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.conv_id, r.turn)):
        convs[r.conv_id].append((r.role, r.text))
    windows = chat.format_windows(df, budget=budget).withColumn("all", chat.read_turns(F.col("formatted")))
    windows = windows.withColumn("said", chat.read_loss(F.col("formatted"), F.col("loss")))
    got = defaultdict(list)
    for r in sorted(windows.collect(), key=lambda r: (r.conv_id, r.block, r.window)):
        every = [(t.role, t.text) for t in r["all"]]
        got[r.conv_id].append((every[: r.n_repeated], every[r.n_repeated :]))
        assert r.said == "".join(t for role, t in every[r.n_repeated :] if role == "assistant")
        assert r.n_tokens <= budget or r.n_new == 1
        assert r.n_new == len(every) - r.n_repeated
    for c, turns in convs.items():
        assert got[c] == brute_windows(turns, budget, 2, tokens), c


def test_control_strings_survive(spark):
    texts = ["<|end|>", "<\\|end|>", "\\", "\\\\<|", "<", "a<", "|>", "<|turn|>x<|text|>y", "<\\\\|", "", None, "🙂<|text|>é"]
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(texts)] + [(2, 0, "<|r|>\\", "x"), (2, 1, None, "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in chat.read_back(chat.format_windows(df, budget=40)).collect()}
    assert back[1].turns_blob == "".join(f"{r}\n{t or ''}\n" for _, _, r, t in rows[: len(texts)])
    assert back[1].loss_blob == "".join(t or "" for _, _, r, t in rows[: len(texts)] if r == "assistant")
    assert back[2].turns_blob == "<|r|>\\\nx\n\ny\n"


def same_as_sql(df, sql, folder, table):
    import duckdb

    c = duckdb.connect()
    c.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    names = sorted(df.columns)
    want = sorted(map(str, c.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()))
    assert sorted(str(tuple(r)) for r in df.select(*names).collect()) == want


def test_long_null_and_repeated_turns_equal_sql(spark, tmp_path):
    """Conversations beyond one block, null and repeated turn numbers at size, and the null conversation."""
    r = __import__("random").Random(4)
    said = lambda: " ".join(r.choice(["a", "bé", "<|x", "\\", "42"]) for _ in range(r.choice([0, 1, 5, 40])))
    rows = [(k, i, "system" if i == 3 and k > 600 else r.choice(["user", "assistant"]), said()) for k in (512, 513, 600, 1100, 1500) for i in range(k)]
    rows += [(None, None if i % 2 else i, r.choice(["user", "assistant", None]), said() + str(i)) for i in range(700)]
    rows += [(7, None, "user", f"null {i}") for i in range(1200)] + [(8, i // 300, "assistant", f"same {i}") for i in range(900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    same_as_sql(queries.op8_chat_windows(spark, str(tmp_path)), oracles.CHAT, tmp_path, "conversations")


def test_many_siblings_equal_sql(spark, tmp_path):
    """One bad branch among clean ones stays alone, at 63, 65 and 300 siblings."""
    urls = []
    for n in (63, 65, 300):
        urls += [f"http://h{n}.example.com/s{chr(97 + k % 26)}{'abcdefghijkl'[k // 26]}/p" for k in range(n - 1) for _ in range(4)]
        urls += [f"http://h{n}.example.com/de/{k}" for k in range(200)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    out = queries.op10_url_filter(spark, str(tmp_path))
    for r in out.collect():
        assert r.verdict == ("block" if r.path.startswith("/de/") else "allow"), r
    same_as_sql(out, oracles.url_sql(queries.URL_RULES), tmp_path, "pages")


def test_long_conversations_fall_into_blocks(spark):
    n = 60
    rows = [(1, i, ("system" if i == 0 else "user" if i % 2 else "assistant"), f"turn {i}") for i in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    w = chat.format_windows(df, budget=60, block_turns=7).withColumn("all", chat.read_turns(F.col("formatted")))
    out = sorted(w.collect(), key=lambda r: (r.block, r.window))
    new = [(t.role, t.text) for r in out for t in r["all"][r.n_repeated :]]
    assert new == [(r, t) for _, _, r, t in rows]
    assert len({r.block for r in out}) == 9
    for r in out[1:]:  # the system turn is retained, and history reaches back over the block's edge
        said = [t.text for t in r["all"]]
        assert said[0] == "turn 0"
        first = int(said[r.n_repeated].split()[1])
        assert said[1 : r.n_repeated] == [f"turn {i}" for i in range(max(1, first - 2), first)]


def test_chat_odd_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"), (None, 1, "assistant", "reply"), (5, 1, "user", "b"), (5, 1, "user", "a"),
        (5, 1, "user", "a"), (5, None, "assistant", "last"), (6, 0, "assistant", "w " * 50_000), (7, -3, "user", "neg"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("block", "window", "turns", "system", "room", "conv", "tokens", "place"):
        df = df.withColumn(c, F.lit(-1))
    back = {r.conv_id: r for r in chat.read_back(chat.format_windows(df, budget=50)).collect()}
    assert back[None].turns_blob == "user\nno conversation\nassistant\nreply\n"
    assert back[5].turns_blob == "user\na\nuser\na\nuser\nb\nassistant\nlast\n" and back[5].loss_blob == "last"
    assert back[6].loss_blob == "w " * 50_000 and back[7].n_turns == 1
    assert chat.format_windows(df.limit(0)).count() == 0
    assert chat.read_back(chat.format_windows(df.limit(0))).count() == 0


# ---------------------------------------------------------------- urls
RULES = queries.URL_RULES


def brute_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return host.translate(str.maketrans(url_templates.UPPER, url_templates.LOWER)), path


def brute_rule(host, path, rules=RULES):
    best = None
    for v, r in rules:
        rh, _, rp = r.partition("/")
        if (host == rh or host.endswith("." + rh)) and path.startswith("/" + rp) and (best is None or len(r) > len(best[1])):
            best = (v, r)
    return best


def odd_pages(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/de/1?x=/fr/#y", "http://example.net?x", "http://a.net/en", "x://é.net/en/ß",
        "http://example.net/en/", "http://notexample.com/de/", "http://a.b.org/fr/2#://z", "http://u://example.com/de/3", "http://net/", "http://h/a\nb",
    ]
    return spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(1, "dup"), (None, "http://n.net/")], "page_id long, url string")


def test_op10_rules(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    df = queries.op10_url_filter(spark, SF)
    assert df.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    assert not python_plan(df._jdf.queryExecution().executedPlan().toString())
    got = {r.page_id: r for r in df.collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        host, path = brute_split(r.url)
        best = brute_rule(host, path)
        x = got[r.page_id]
        assert (x.host, x.path, x.rule) == (host, path, best and best[1])
        assert x.verdict == best[0] if best else x.verdict in ("allow", "block")


@pytest.mark.parametrize("inline", [256, 0])
def test_odd_urls(spark, inline):
    pages = odd_pages(spark)
    for c in ("host", "path", "rule", "bad", "segs", "template", "n", "token"):
        pages = pages.withColumn(c, F.lit("x"))
    rules = [*RULES, ("allow", "example.com/de/")]
    got = url_templates.filter_urls(pages, rules, max_inline=inline).collect()
    want = []
    for r in pages.collect():
        host, path = brute_split(r.url)
        best = brute_rule(host, path, sorted(rules, key=lambda x: x[0] != "block"))
        want.append((str(r.page_id), host, path, str(best and best[1]), best and best[0]))
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict if r.rule else None) for r in got) == sorted(want, key=str)
    assert all(r.verdict == "allow" for r in got if not r.host)
    assert url_templates.filter_urls(pages.limit(0), RULES).count() == 0
    assert url_templates.filter_urls(pages, []).count() == pages.count()


def test_template_tree(spark):
    """Variable segments generalise, like branches merge, unlike ones stay, purity rejects."""
    rows = [(f"/item/{i}", None) for i in range(50)]
    rows += [(f"/tag/{'abcdefghij'[i % 10] * 3}{chr(97 + i // 10)}", i % 2 == 0) for i in range(100)]  # one label mix in every child
    rows += [(f"/spam/offer-{i}", True) for i in range(40)] + [(f"/news/story-{i}", False) for i in range(40)]
    df = spark.createDataFrame([(i, f"http://h.org{p}", b) for i, (p, b) in enumerate(rows)], "page_id long, url string, bad boolean")
    got = {r.page_id: r for r in url_templates.filter_urls(df, [], label=F.col("bad")).collect()}
    by_path = defaultdict(set)
    for i, (p, _) in enumerate(rows):
        by_path[p.split("/")[1]].add((got[i].template, got[i].verdict))
    assert by_path["spam"] == {("/spam/offer-#", "block")} and by_path["news"] == {("/news/story-#", "allow")}
    assert {v for _, v in by_path["item"]} == {"allow"} and all(t.endswith("/#") for t, _ in by_path["item"])
    assert all(t.endswith("/*") for t, _ in by_path["tag"])
    x = got[150]
    assert abs(x.purity - (40 + 1) / (40 + 5)) < 1e-12


def test_segments(spark):
    paths = ["", "/", "/a/12/b3", "/a/b/c/d/e/f7", "a//b"]
    df = spark.createDataFrame([(p,) for p in paths], "path string").select(url_templates.segments(F.col("path")).alias("s"))
    assert [r.s for r in df.collect()] == [[""], [""], ["a", "#", "b#"], ["a", "b", "c", "d/e/f#"], ["a", "", "b"]]
