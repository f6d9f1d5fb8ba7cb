import hashlib
import itertools
import random
import re
import zlib

import pytest

from schoolyard.llm.repair import cheapest_repair, damaged, repair_damaged, repaired, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def plain_cheapest(codes: str) -> tuple[int, str]:
    """All sequences of edits, with up to two insertions before each row and at the end."""
    best = None
    gaps = itertools.product(*[("", "I", "II")] * (len(codes) + 1))
    options = ["D" if c == "X" else "DKR" for c in codes]
    for inserted in gaps:
        for edits in itertools.product(*options):
            audit = "".join(i + e for i, e in zip(inserted, (*edits, ""), strict=True))
            # the role of an inserted or changed turn follows from its place
            for first in ("", "s"):
                rows, cost, fits, initials = iter(codes), 0, True, []
                for letter in audit:
                    code = "" if letter == "I" else next(rows)
                    if letter == "D":
                        cost += 4
                        continue
                    cost += 3 * (letter in "IR") + 3 * code.isupper()
                    due = first if first and not initials else "ua"[(len(initials) - len(first)) % 2]
                    fits &= code.lower() == due if letter == "K" else due != "s"
                    initials.append(due)
                fits &= initials[:1] == ["s"] or not first
                if fits and GRAMMAR.match("".join(initials)) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def plain_repair(turns: list[tuple]) -> dict:
    """The whole contract in plain Python over (conv_id, turn, role, text)."""
    by_conv: dict = {}
    for conv, turn, role, text in turns:
        rows = by_conv.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    found = {}
    for conv, rows in by_conv.items():
        digest = lambda r: hashlib.md5(
            f"false\n{'' if conv is None else conv}\n{len(r[1])}\n{r[1]}\n{r[2]}".encode()
        ).hexdigest()
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        codes, seen = [], set()
        counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        for i, (_, role, text) in enumerate(rows):
            kept = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not kept else "duplicate" if (role, text) in seen else ""
            fault = fault or ("" if kept[-1] in ".!?" else "truncated")
            seen.add((role, text))
            code = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes.append("X" if fault in ("blank", "duplicate") else code.upper() if fault else code)
            if fault:
                counts[fault] += 1
            if i and rows[i - 1][1][:1] + role[:1] not in ("su", "ua", "au"):
                counts["illegal"] += 1
        numbers = [r[0] for r in rows if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit = cheapest_repair("".join(codes))
        whole = "\n".join(f"{r}:{t}" for r, t in repaired_turns(audit, iter([r[1:] for r in rows])))
        sha = hashlib.sha256(whole.encode()).hexdigest()
        found[conv] = (gaps, *counts.values(), cost, audit, sha)
    return found


def by_conversation(df) -> dict:
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("length", range(5))
def test_the_search_finds_what_trying_everything_finds(length):
    draw = random.Random(length)
    every = list(itertools.product("suaoSUAOX", repeat=length))
    for codes in draw.sample(every, min(len(every), 60)):
        assert cheapest_repair("".join(codes)) == plain_cheapest("".join(codes)), codes


def test_ties_go_to_the_least_audit():
    assert cheapest_repair("") == (0, "")
    assert cheapest_repair("ua") == (0, "KK")
    assert cheapest_repair("s") == (4, "D")
    assert cheapest_repair("uu") == (3, "KR")  # not KIKI
    assert cheapest_repair("uua") == (3, "KIKK")
    assert cheapest_repair("a") == (3, "IK")


def test_long_conversations_are_searched_in_time():
    draw = random.Random(5)
    codes = "s" + "".join(draw.choice("uauauaUAXo") for _ in range(20_000))
    cost, audit = cheapest_repair(codes)
    assert len(audit.replace("I", "")) == len(codes) and cost > 0


def test_every_conversation_agrees_with_the_plain_version(spark):
    draw = random.Random(11)
    texts = ["Yes.", "no", "", "  ", "Why?\n", "a b c!", "ends ", None, "x" * 50_000 + "."]
    rows = [
        (conv, turn, draw.choice(["user", "assistant", "system", "tool", "", None]), draw.choice(texts))
        for conv in [*range(120), None]
        for turn in [*range(draw.randrange(12)), *([None] * draw.randrange(3)), draw.randrange(40)]
    ]
    rows += rows[:200]  # repeated rows
    draw.shuffle(rows)
    assert by_conversation(repair_damaged(spark.createDataFrame(rows, SCHEMA))) == plain_repair(rows)


def test_a_conversation_cut_in_many_pieces_is_one(spark):
    draw = random.Random(3)
    rows = [(7, t, draw.choice(["user", "assistant"]), draw.choice(["Yes.", f"No {t}.", "so", ""])) for t in range(4000)]
    rows += [(c, 0, "user", "Hi.") for c in range(20, 40)]
    assert by_conversation(repair_damaged(spark.createDataFrame(rows, SCHEMA).repartition(8))) == plain_repair(rows)


def test_a_conversation_without_rows_left_has_an_empty_repair(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = spark.createDataFrame([(5, turn, "user", "Hello.")], SCHEMA)
    assert by_conversation(repair_damaged(rows)) == {
        5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    }
    assert repair_damaged(rows.limit(0)).count() == 0


def test_damage_follows_from_the_key_and_other_columns_do_no_harm(spark):
    rows = spark.createDataFrame([(1, t, "assistant", "One. Two!") for t in range(40)], SCHEMA)
    extra = rows.selectExpr("*", "'x' AS dropped", "1 AS digest", "2 AS part", "3 AS audit")
    by_kind = {}
    for r in damaged(extra).collect():
        by_kind.setdefault(zlib.crc32(f"1:{r['turn']}".encode()) % 20, []).append(r)
    assert all(r["dropped"] for r in by_kind[0])
    assert {r["text"] for r in by_kind[1]} == {""} and {r["text"] for r in by_kind[2]} == {"One Two"}
    assert {r["role"] for r in by_kind[4]} == {"user"}
    assert by_conversation(repair_damaged(extra)) == by_conversation(repair_damaged(rows))


def test_the_operator_takes_rows_as_they_are(spark):
    rows = [(1, 0, "system", "Be kind.", False), (1, 1, "assistant", "Hi.", False), (1, 2, "tool", "cut", False)]
    got = repaired(spark.createDataFrame(rows, SCHEMA + ", dropped boolean")).first()
    assert (got["cost"], got["audit"], got["truncated"], got["illegal"]) == (7, "KIKD", 1, 2)
