import hashlib
import itertools
import re
import zlib
from collections import defaultdict
from functools import lru_cache

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import turns
from quarry.llm.common import table
from quarry.llm.queries import QUERIES

NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def cheapest(rows):
    """(cost, letters) as a plain recursion over strings; rows: (initial, drop, cut)."""
    @lru_cache(maxsize=None)
    def best(i, last, inserted):
        out = []
        role = "a" if last == "u" else "u"
        if i == len(rows):
            if last in ("", "a"):
                out.append((0, ""))
        else:
            initial, drop, cut = rows[i]
            c, t = best(i + 1, last, 0)
            out.append((c + 4, "D" + t))
            if not drop:
                c, t = best(i + 1, role, 0)
                out.append((c + 3 + 3 * cut, "R" + t))
                if initial == role or (initial == "s" and last == ""):
                    c, t = best(i + 1, initial, 0)
                    out.append((c + 3 * cut, "K" + t))
        if inserted < 3:
            c, t = best(i, role, inserted + 1)
            out.append((c + 3, "I" + t))
        return min(out, default=(10**9, ""))

    return best(0, "", 0)


def weighed(rows):
    r = turns.Repair()
    for row in rows:
        r.turn(*row)
    return r.finish()


def tried(rows):
    """Every sequence of edits with up to two inserts at a place."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            text = "".join("I" * g + e for g, e in zip(gaps, [*edits, ""]))
            for choice in itertools.product("ua", repeat=sum(x in "RI" for x in text)):
                pick, i, out, cost = iter(choice), 0, "", 0
                for letter in text:
                    cost += {"D": 4, "I": 3, "K": 0, "R": 3}[letter]
                    if letter != "I":
                        initial, drop, cut = rows[i]
                        i += 1
                        if letter != "D":
                            cost += 10**6 * drop + 3 * cut
                    out += {"D": "", "K": initial if letter == "K" else ""}.get(letter) if letter in "DK" else next(pick)
                if re.fullmatch(r"(s?(ua)+)?", out) and (best is None or (cost, text) < best):
                    best = (cost, text)
    return best


def test_weights_against_every_sequence_of_edits():
    kinds = [("u", False, False), ("a", False, False), ("s", False, False), ("a", True, False), ("s", False, True), ("x", False, False)]
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            assert weighed(rows) == tried(rows) == cheapest(tuple(rows))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suaux "), st.booleans(), st.booleans()), max_size=40))
def test_weights_against_strings(rows):
    assert weighed(rows) == cheapest(tuple(rows))


def test_long_conversations_cross_blocks():
    import random
    rng = random.Random(1)
    for kinds, n in (("u", 300), ("s", 200), ("a", 131), ("ua", 400), ("sua", 400), ("uuax", 333)):
        rows = tuple((rng.choice(kinds), rng.random() < 0.1, rng.random() < 0.2) for _ in range(n))
        assert weighed(rows) == cheapest(rows)
    many = turns.Repair()  # never decided before its end, yet of one width
    for _ in range(50_000):
        many.turn("u", False, False)
        assert all(w is None or w.bit_length() < turns.HIGH + 24 for w in many.weight)
    assert len(many.finish()[1]) >= 50_000


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def truth(rows):
    convs = defaultdict(list)
    for r in rows:
        convs[r[0]]
    for r in damaged(rows):
        convs[r[0]].append(r)
    out = {}
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{r[2]}\0{r[3]}".encode()).digest()))
        seen, facts, counts = set(), [], [0, 0, 0]
        for _, _, role, text in mine:
            bare = text.strip(" \t\n\x0b\f\r")
            blank, double, cut = not bare, (role, text) in seen, bare[-1:] not in (".", "!", "?")
            seen.add((role, text))
            fault = 0 if blank else 1 if double else 2 if cut else None
            if fault is not None:
                counts[fault] += 1
            facts.append((role[:1], fault in (0, 1), fault == 2))
        ts = {r[1] for r in mine if r[1] is not None}
        gaps = max(ts) - min(ts) + 1 - len(ts) if ts else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(facts, facts[1:]))
        cost, audit = cheapest(tuple(facts))
        last, i, parts = "", 0, []
        for letter in audit:
            role, text = ("", "") if letter == "I" else mine[i][2:]
            i += letter != "I"
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if last == "u" else "user"
            last = role[0]
            parts.append(f"{role}:{text}")
        out[conv] = (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(parts).encode()).hexdigest())
    return out


def result(df):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in df.select(NAMES).collect()}


def test_query_against_brute_force(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
        got = result(QUERIES["op13_conversation_repair"](spark, sf))
        assert got == truth(rows) and len(got) > 10
        assert sum(len(v[7]) for v in got.values()) > 0


EDGE = [(1, None, "user", "a."), (1, None, "user", "a."), (1, 0, "assistant", "b"), (1, 7, None, "c."), (1, -3, "system", None), (2, 1, "", " \n"), (2, 2, "assistant", "x?\t "),
        (None, 1, "user", "Who?"), (None, 2, "user", "Who?"), (None, None, "tool", "z" * 200_000 + "."), (4, 1 << 62, "user", "é."), (4, 3, "user", "é."), (4, 5, "assistant", "ü!"),
        *[(5, i, "user", "same.") for i in range(30)], *[(6, i, "user" if i % 3 else "assistant", f"t{i}.") for i in range(150)]]


def test_nulls_ties_repeats_and_clashing_columns(spark, tmp_path):
    spark.createDataFrame(EDGE, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS hash", "2 AS kind", "3 AS report", "4 AS c", "5 AS k", "6 AS copy").write.parquet(str(tmp_path / "conversations.parquet"))
    got = result(QUERIES["op13_conversation_repair"](spark, str(tmp_path)))
    assert got == truth(EDGE)


def test_conversations_of_dropped_rows_and_empty_tables(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "a.")], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = result(QUERIES["op13_conversation_repair"](spark, str(tmp_path)))
    assert got == {gone: (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    assert result(QUERIES["op13_conversation_repair"](spark, str(tmp_path / "none"))) == {}


def test_repaired_turns_alternate(spark):
    rows = spark.createDataFrame(EDGE, "conv_id long, turn long, role string, text string")
    found = turns.reports(rows)
    out = defaultdict(list)
    for r in turns.repaired(rows, found).orderBy("conv_id", "position").collect():
        out[r.conv_id].append(r)
    assert all(re.fullmatch("s?(ua)+", "".join(r.role[0] for r in c)) for c in out.values())
    letters = {r.conv_id: r.audit.replace("D", "") for r in found.collect()}
    assert {c: "".join(r.edit for r in rs) for c, rs in out.items()} == {c: a for c, a in letters.items() if a}
    assert [r.position for r in out[6]] == list(range(len(out[6])))
