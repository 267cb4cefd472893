"""Conversation repair against a brute-force version."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from assayflow.llm import repair
from assayflow.llm.queries import op13_damaged

SPACE = " \t\n\x0b\x0c\r"


def slow_faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        if not body:
            found.append(repair.BLANK)
        elif (role, text) in seen:
            found.append(repair.DUPLICATE)
        else:
            found.append(repair.SOUND if body[-1] in ".!?" else repair.TRUNCATED_TURN)
        seen.add((role, text))
    return found


def slow_best(initials, kinds):
    """Least (cost, audit) over all edit sequences, by a plain recursion on turns."""

    def follows(state, letter):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, letter))

    @lru_cache(None)
    def best(i, state, inserted):
        options = [(0, "")] if i == len(initials) and state in ("", "a") else []
        if inserted < 3:
            for letter in "ua":
                if follows(state, letter):
                    cost, rest = best(i, follows(state, letter), inserted + 1)
                    options.append((cost + 2, "I" + rest))
        if i < len(initials):
            cost, rest = best(i + 1, state, 0)
            options.append((cost + 3, "D" + rest))
            if kinds[i] in (repair.SOUND, repair.TRUNCATED_TURN):
                more = int(kinds[i] == repair.TRUNCATED_TURN)
                for letter, edit, cost_of in [(initials[i], "K", 0), ("u", "R", 2), ("a", "R", 2)]:
                    if follows(state, letter):
                        cost, rest = best(i + 1, follows(state, letter), 0)
                        options.append((cost + cost_of + more, edit + rest))
        return min(options, default=(10**9, "~"))

    return best(0, "", 0)


def slow_repaired(rows, audit):
    out, state, at = [], "", 0
    following = {"": "u", "s": "u", "u": "a", "a": "u"}
    for edit in audit:
        if edit == "I":
            state = following[state]
            out.append(("user" if state == "u" else "assistant") + ":")
            continue
        _, role, text = rows[at]
        at += 1
        if edit == "K":
            state = role[0]
            out.append(f"{role}:{text}")
        elif edit == "R":
            state = following[state]
            out.append(("user:" if state == "u" else "assistant:") + text)
    assert at == len(rows) and re.fullmatch(r"(s?(ua)+)?", "".join(x[0] for x in out))
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def slow(rows):
    """All columns but the id, for the sorted (turn, role, text) rows of a conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    kinds = slow_faults(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = min(max(turns) - min(turns) + 1 - len(set(turns)), (1 << 63) - 1) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    cost, audit = slow_best(tuple(initials), tuple(kinds))
    counts = [kinds.count(k) for k in (repair.BLANK, repair.DUPLICATE, repair.TRUNCATED_TURN)]
    return (gaps, *counts, illegal, cost, audit, slow_repaired(rows, audit))


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows, present=None, want=None):
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, symbol int, audit int").repartition(3)
    audits, turns = repair.repair(frame, present)
    digests = repair.digests(turns)
    got = audits.join(digests, audits.conv_id.eqNullSafe(digests.conv_id)).select(audits.conv_id, *COLUMNS).collect()
    if want is None:
        by = {}
        for c, t, r, x in rows:
            by.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
        want = {c: slow(v) for c, v in by.items()}
    assert {r[0]: tuple(r)[1:] for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("length", range(7))
def test_programme_against_brute_force(length):
    random.seed(length)
    for _ in range(400):
        kinds = [random.choice([repair.BLANK, repair.DUPLICATE, repair.TRUNCATED_TURN, repair.SOUND, repair.SOUND]) for _ in range(length)]
        letters = [random.randrange(4) for _ in range(length)]
        runs = [(s, len(list(g))) for s, g in itertools.groupby(4 * k + x for k, x in zip(kinds, letters, strict=True))]
        assert repair.cheapest(runs) == slow_best(tuple("sua?"[x] for x in letters), tuple(kinds))


def test_long_runs_equal_single_turns():
    random.seed(9)
    for _ in range(30):
        runs = [(random.randrange(16), random.choice([1, 2, 63, 64, 65, 200, 1000])) for _ in range(4)]
        runs = [r for i, r in enumerate(runs) if not i or r[0] != runs[i - 1][0]]
        single = [(s, 1) for s, n in runs for _ in range(n)]
        assert repair.cheapest(runs) == repair.cheapest(single)


def test_conversations_against_brute_force(spark):
    random.seed(3)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No", "Ok!  ", "", " \n", "Why?\t", "é", "Yes.", None, "a "]
    rows = [(c, random.choice([None, *range(6)]), random.choice(roles), random.choice(texts)) for c in range(60) for _ in range(random.randrange(1, 8))]
    rows += [(500, 0, "user", "Hi."), (500, (1 << 63) - 1, "assistant", "x" * 100_000), (501, -(1 << 63), "user", "?"), (501, (1 << 63) - 1, "user", "!")]
    rows += [(None, 0, "user", "Hi."), (None, 1, "user", "Hi.")]
    check(spark, rows)


def test_long_conversation(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"{i % 700}.") for i in range(1500)] + [(2, 5, "user", "a") for _ in range(50)]
    got = {}
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    audits, turns = repair.repair(frame)
    for r in audits.collect():
        got[r["conv_id"]] = r
    kinds = slow_faults([r[1:] for r in rows[:1500]])
    assert [got[1]["duplicate"], got[2]["duplicate"], got[2]["truncated"]] == [kinds.count(repair.DUPLICATE), 49, 1]
    single = [(4 * k + (1 if r[2] == "user" else 2), 1) for k, r in zip(kinds, rows[:1500], strict=True)]
    assert (got[1]["cost"], got[1]["audit"]) == repair.cheapest(single)
    written = [r for r in turns.where("seq > 0 and conv_id = 1").orderBy("seq").collect()]
    assert re.fullmatch(r"(ua)+", "".join(r["role"][0] for r in written)) and len(written) == sum(e != "D" for e in got[1]["audit"])


def test_damage(spark):
    random.seed(4)
    rows = [(c, t, "user" if t % 2 else "assistant", f"Text {c}. Really? {t}!") for c in range(40) for t in range(random.randrange(1, 6))] + [(c, 0, "user", "One.") for c in range(100, 200)] + [(None, None, None, None), (77, None, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {}
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        out = want.setdefault(c, [])
        if kind:
            row = (t, "user" if kind == 4 else r, "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x)
            out += [row] * (1 + (kind == 3))
    damaged = op13_damaged(frame)
    audits, turns = repair.repair(damaged, damaged["present"])
    digests = repair.digests(turns)
    got = audits.join(digests, audits.conv_id.eqNullSafe(digests.conv_id)).select(audits.conv_id, *COLUMNS).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {c: slow(v) for c, v in want.items()}
    assert any(not v for v in want.values())


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    audits, turns = repair.repair(frame)
    assert audits.count() == 0 and turns.count() == 0
