import hashlib
import itertools
import random
import re
import zlib

import duckdb
from lakeloom.llm import conversation_repair as c

SPACE = " \t\n\v\f\r"


def damage(rows):
    """Rows (conv, turn, role, text) after damage, by conversation."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        mine += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        t = text.strip(SPACE)
        out.append("blank" if not t else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, lines) by the plain recursion over rows and role strings that may be continued."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "", ())}

    def inserted(now):
        for _ in range(2):
            more = dict(now)
            for s, (cost, audit, lines) in now.items():
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (s, x) in after:
                        new = (cost + 5, audit + "I", (*lines, f"{name}:"))
                        t = after[s, x]
                        more[t] = min(more.get(t, new), new)
            now = more
        return now

    for (_, role, text), fault in zip(rows, found):
        new = {}
        for s, (cost, audit, lines) in inserted(best).items():
            ways = [(2, "D", s, ())]
            if fault not in ("blank", "duplicate"):
                stay = 5 * (fault == "truncated")
                if (s, role[:1]) in after:
                    ways.append((stay, "K", after[s, role[:1]], (f"{role}:{text}",)))
                ways += [(stay + 1, "R", after[s, x], (f"{name}:{text}",)) for x, name in (("u", "user"), ("a", "assistant")) if (s, x) in after]
            for more, letter, t, line in ways:
                x = (cost + more, audit + letter, lines + line)
                new[t] = min(new.get(t, x), x)
        best = new
    done = inserted(best)
    return min(done[s] for s in ("", "a") if s in done)


def exhaustive(rows, found):
    """The same by trying all edits of a few rows."""
    fill = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    best = None
    ways = [[("D", "", 2)] if f in ("blank", "duplicate") else [("D", "", 2), ("K", r[1][:1] or "-", 5 * (f == "truncated")), ("R", "u", 1 + 5 * (f == "truncated")), ("R", "a", 1 + 5 * (f == "truncated"))] for r, f in zip(rows, found)]
    for own in itertools.product(*ways):
        for gaps in itertools.product(fill, repeat=len(rows) + 1):
            roles, audit, cost = "".join(gaps[0]), "I" * len(gaps[0]), 5 * len(gaps[0])
            for (letter, role, price), gap in zip(own, gaps[1:]):
                roles, audit, cost = roles + role + "".join(gap), audit + letter + "I" * len(gap), cost + price + 5 * len(gap)
            if re.fullmatch("(s?(ua)+)?", roles):
                best = min(best or (cost, audit), (cost, audit))
    return best


def report(rows):
    found = faults(rows)
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest(rows, found)
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, *(found.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))


def some_rows(rng, n):
    texts = ["a.", "b!", "cut", " ", "", "x? ", "y.\n", "é…", "long " * 50 + ".", "z.\u2028", "v.\u2029\n"]
    return [(rng.choice([None, *range(9)]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "User", " "]), rng.choice(texts) or "") for _ in range(n)]


def test_recursion_equals_all_edits():
    rng = random.Random(3)
    for k in range(60):
        rows = some_rows(rng, rng.choice([0, 1, 2, 2, 2, 3]))
        found = faults(rows)
        assert cheapest(rows, found)[:2] == exhaustive(rows, found), rows


def test_matrices_and_choices_equal_the_recursion():
    rng = random.Random(5)
    for k in range(400):
        rows = some_rows(rng, rng.choice([0, 1, 3, 8, 40]))
        found = faults(rows)
        symbol = [c.GONE if f in ("blank", "duplicate") else ("sua".find(r[1][:1]) % 4 if r[1] else 3) + 4 * (f == "truncated") for r, f in zip(rows, found)]
        runs = c.packed(c.np.array(symbol, int), c.np.ones(len(symbol), int))
        cost, audit, _ = cheapest(rows, found)
        assert c.before(c.piece(runs), c._END)[0] == cost
        assert c.unroll(runs, 0, c._END, True)[0] == audit
    assert c.run(1, 1000) == c.piece(c.packed(c.np.ones(1000, int), c.np.ones(1000, int)))


def by_sql(path):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{path}'")
    return sorted(con.execute(c.ORACLE_SQL).fetchall(), key=str)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = sorted((k, *report(ordered(v))) for k, v in damage(rows).items())
    df = c.op11_conversation_repair(spark, sf_dir)
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = sorted(map(tuple, df.collect()))
    assert got == want and by_sql(f"{sf_dir}/conversations.parquet") == sorted(got, key=str)
    assert any(r[5] for r in want) and any("R" in r[7] for r in want) and any(not r[6] for r in want)


def test_odd_rows_and_long_conversations(spark, tmp_path):
    rng = random.Random(9)
    rows = [(conv, *r) for conv in (None, 1, 2, 3, 4) for r in some_rows(rng, rng.choice([1, 5, 12]))]
    rows += [(1, None, None, None), (None, None, None, None), (1, 3, "user", None), (1, 3, "user", "same."), (1, 3, "user", "same."), (5, 0, None, "z" * 100_000)]
    rows += [(77, t, rng.choice(["user", "assistant"]), rng.choice([f"text {t}.", f"cut {t}", "again."])) for t in range(3000)]  # most of the table
    rows += [(k, 0, "user", "gone?") for k in range(100, 160)]  # some are dropped as a whole
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as conv", "2 as n", "3 as digest", "4 as `a.b`")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert c.pieces(c.faults(c.damaged(df))).filter("conv = 77").count() > 1  # in several tasks
        got = {r[0]: tuple(r)[1:] for r in c.op11_conversation_repair(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {k: report(ordered(v)) for k, v in damage(rows).items()}
    assert got == want
    few = df.filter("conv_id is null or conv_id <> 77")
    few.coalesce(1).write.parquet(str(tmp_path / "few"))
    assert by_sql(str(tmp_path / "few" / "*.parquet")) == sorted(((k, *v) for k, v in want.items() if k != 77), key=str)
    assert got[[k for k in range(100, 160) if zlib.crc32(f"{k}:0".encode()) % 20 == 0][0]] == (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    empty = c.audits(c.rows_of(df.limit(0)))
    assert empty.count() == 0


def test_repaired_rows(spark):
    rows = [("x", 1, "user", "Hello"), ("x", 2, "user", "Are you there?"), ("x", 3, "user", "Still."), ("x", 4, "assistant", "Yes."), ("y", 1, "system", "Be brief.")]
    df = c.rows_of(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"))
    audit = c.audits(df)
    assert sorted((r.conv, r.cost, r.audit) for r in audit.collect()) == [("x", 4, "DDKK"), ("y", 2, "D")]
    assert [tuple(r) for r in c.repaired(df, audit).collect()] == [("x", 0, "user", "Still."), ("x", 1, "assistant", "Yes.")]
