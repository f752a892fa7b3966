"""Repairs by block tables against a plain search, and damage by rule."""

import hashlib
import random
import zlib

import pytest

from packwright.llm import conversation_repair as repair

SCHEMA = "conv string, conv_id bigint, turn bigint, role string, text string, row bigint"
FULL = {"u": "user", "a": "assistant"}


def fits(roles: str) -> bool:
    rest = roles[1:] if roles[:1] == "s" else roles
    return roles == "" or bool(rest) and rest == "ua" * (len(rest) // 2)


def damage(rows):
    """Rows of one table after damage, in order, by conversation."""
    found = {}
    for _, conv, turn, role, text, _ in rows:
        kept = found.setdefault(conv, [])
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if lot == 1:
            text = ""
        if lot == 2:
            text = "".join(c for c in text if c not in ".!?")
        if lot == 4:
            role = "user"
        kept.extend([(turn, role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1))
    for kept in found.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()))
    return found


def plain(rows) -> tuple:
    """The result for one conversation, by the least (cost, letters) of all states, row by row."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def grown(best):
        for _ in range(4):
            for roles, (cost, letters, out) in list(best.items()):
                for r in "ua":
                    new = state(roles, r)
                    if new is not None:
                        option = (cost + 3, letters + "I", [*out, FULL[r] + ":"])
                        best[new] = min(best.get(new, option), option)
        return best

    def state(now, r):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((now, r))

    best = grown({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}

        def offer(roles, option):
            if roles is not None:
                new[roles] = min(new.get(roles, option), option)

        for roles, (cost, letters, out) in best.items():
            offer(roles, (cost + 4, letters + "D", out))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                offer(state(roles, role[:1]), (cost + more, letters + "K", [*out, f"{role}:{text}"]))
                for r in "ua":
                    offer(state(roles, r), (cost + more + 3, letters + "R", [*out, f"{FULL[r]}:{text}"]))
        best = grown(new)
    cost, letters, out = min(best[s] for s in ("", "a") if s in best)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    text = "\n".join(out)
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest()


def table(seed: int, conversations: int, longest: int):
    pick, rows = random.Random(seed), []
    for conv in [None, *range(conversations)]:
        for turn in range(pick.randrange(longest)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ärzte"])
            text = pick.choice(["Yes.", "No!", "cut", "", None, " \n", f"Text {turn}?", f"é {turn}", "a\tb. "])
            rows.append(("x", conv, pick.choice([turn, turn, turn, turn + 2, None]), role, text, 1))
    return rows


def found(spark, rows, damaged=True, parts=4, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    result = repair.repair((repair.damaged if damaged else repair.untouched)(df), **options)
    assert result.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in result.collect()), key=repr)


def test_random_conversations(spark):
    rows = table(1, 150, 12)
    assert found(spark, rows) == sorted(((c, *plain(kept)) for c, kept in damage(rows).items()), key=repr)


def test_chunks_of_few_rows(spark):
    rows = table(2, 6, 400)
    assert found(spark, rows, chunk=7) == sorted(((c, *plain(kept)) for c, kept in damage(rows).items()), key=repr)


def test_one_conversation_over_many_tasks(spark):
    pick = random.Random(3)
    rows = [("x", 7, i, pick.choice(["user", "assistant", "system"]), pick.choice([f"t{i}.", f"t{i}", "same."]), 0) for i in range(9000)]
    rows += [("x", 8, 1, "user", "a.", 0), ("x", 9, None, None, None, 0)]
    assert found(spark, rows) == sorted(((c, *plain(kept)) for c, kept in damage(rows).items()), key=repr)


def test_hot_repeated_rows_and_long_texts(spark):
    rows = [("x", 3, 12, "user", "again.", 0)] * 5000 + [("x", 3, 13, "assistant", "long " * 400_000 + ".", 0), ("x", 4, 2, "user", "hi.", 0)]
    assert found(spark, rows, parts=6) == sorted(((c, *plain(kept)) for c, kept in damage(rows).items()), key=repr)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_every_row_lost(spark):
    # A conversation all of whose rows the damage drops keeps its row.
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(spark, [("x", lost, 0, "user", "a.", 0)]) == [(lost, 0, 0, 0, 0, 0, 0, "", empty)]


def test_without_damage(spark):
    rows = [("x", 1, i, r, t, 0) for i, (r, t) in enumerate([("user", "a."), ("user", "b."), ("assistant", "c.")])]
    text = hashlib.sha256(b"user:a.\nassistant:\nuser:b.\nassistant:c.").hexdigest()
    assert found(spark, rows, damaged=False) == [(1, 0, 0, 0, 0, 1, 3, "KIKK", text)]


@pytest.mark.parametrize("seed", range(6))
def test_transitions_of_chunks_agree_with_whole_lookups(seed):
    pick = random.Random(seed)
    signs = [pick.randrange(9) for _ in range(64)]
    whole = repair.blocks_of(signs)
    vectors, cost = repair.looked_up(whole)
    head, tail = repair.blocks_of(signs[:28]), repair.blocks_of(signs[28:])
    following, growth, leaving = repair.transition(tail)
    first, more, entered = repair.transition(head)
    middle = following[0]
    assert first[middle] == vectors[0] and growth[0] + more[middle] == cost
    rows = [(b"user", b"x")] * 64
    letters, _, state = repair.expanded(whole, rows, 0, repair.START)
    left, _, between = repair.expanded(head, rows[:28], int(middle), repair.START)
    right, _, last = repair.expanded(tail, rows[28:], 0, between)
    assert left + right == letters and last == state
    assert entered[middle, repair.START] == between and leaving[0, between] == last
