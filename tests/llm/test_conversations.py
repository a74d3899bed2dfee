import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from feedlens.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, fault string, row string, conv string"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        blank = lambda v: " " if v is None else v
        h = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def faults_of(rows):
    found, seen = [], set()
    for _, _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
        found.append(0 if not last else 1 if (role, text) in seen else
                     2 if last not in ".!?" else None)
        seen.add((role, text))
    return found


def best_edits(rows, faults):
    """Least (cost, audit, lines) by trying every edit at every place."""
    @lru_cache(None)
    def rest(i, state, inserts):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserts < 3:
            for role in ("user", "assistant"):
                if (state, role[0]) in NEXT:
                    c, a, t = rest(i, NEXT[state, role[0]], inserts + 1)
                    options.append((c + 2, "I" + a, (f"{role}:", *t)))
        if i < len(rows):
            _, _, role, text = rows[i]
            c, a, t = rest(i + 1, state, 0)
            options.append((c + 3, "D" + a, t))
            if faults[i] not in (0, 1):
                more = int(faults[i] == 2)
                if (state, role[:1]) in NEXT:
                    c, a, t = rest(i + 1, NEXT[state, role[:1]], 0)
                    options.append((c + more, "K" + a, (f"{role}:{text}", *t)))
                for goal in ("user", "assistant"):
                    if (state, goal[0]) in NEXT:
                        c, a, t = rest(i + 1, NEXT[state, goal[0]], 0)
                        options.append((c + 2 + more, "R" + a, (f"{goal}:{text}", *t)))
        return min(options, default=(10 ** 9, "", ()))
    return rest(0, "", 0)


def expected(rows, damage=True):
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == conv]
        mine = sorted(hurt(mine) if damage else mine, key=lambda r: (
            r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        faults, turns = faults_of(mine), {r[1] for r in mine if r[1] is not None}
        initials = [r[2][:1] for r in mine]
        cost, audit, lines = best_edits(mine, faults)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *[faults.count(k) for k in range(3)],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def random_rows(seed, convs, longest):
    rng = np.random.default_rng(seed)
    texts = ["Fine.", "no end", "", " \n", "Ends! ", "Why?\t", "twice.", ". no", "é…"]
    roles = ["user", "assistant", "system", "tool", "", None]
    rows = []
    for conv in range(convs):
        for turn in range(int(rng.integers(0, longest))):
            rows.append((conv if conv % 17 else None, None if rng.random() < .1 else
                         turn + int(rng.integers(0, 3)),
                         roles[rng.choice(6, p=[.4, .35, .1, .05, .05, .05])],
                         None if rng.random() < .05 else texts[int(rng.integers(0, 9))]
                         + (str(turn) if rng.random() < .5 else "") + ("." if rng.random() < .3
                                                                      else "")))
    return rows


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert got(cv.op13_conversation_repair(spark, sf_dir)) == expected(rows)


@pytest.mark.parametrize("block_rows", [1, 2, 1024])
def test_random_conversations(spark, block_rows):
    rows = hurt(random_rows(block_rows, 60, 9))
    assert got(cv.repair(frame(spark, rows), block_rows)) == expected(rows, damage=False)


def test_damage_nulls_and_extra_columns(spark):
    rows = random_rows(9, 80, 8)
    assert got(cv.audit_conversations(frame(spark, rows).repartition(5))) == expected(rows)


def test_hot_conversation_over_many_tasks(spark):
    rng = np.random.default_rng(3)
    rows = [(7, t, ["user", "assistant"][int(rng.random() < .5)],
             ["Same text.", f"text {t}.", f"cut {t}"][int(rng.integers(0, 3))])
            for t in range(150)]
    rows += [(100 + i, t, "user", "Hello.") for i in range(40) for t in range(3)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = got(cv.repair(frame(spark, rows).repartition(6), 20))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert found == expected(rows, damage=False)


def test_nothing_left_and_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = cv.audit_conversations(frame(spark, [(gone, 0, "user", "Hi.")])).collect()
    assert [tuple(r) for r in row] == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert cv.audit_conversations(frame(spark, [])).collect() == []


def test_a_block_repairs_from_every_state():
    initials, faults = ["u", "u", "a", "s"], [None, 1, 2, None]
    table = cv.least_costs(cv.row_arcs(initials, faults), 4, np.where(
        np.eye(4, dtype=bool), 0, cv.FAR).astype(np.int64))[:4]
    for end in range(4):
        after = [0 if s == end else cv.FAR for s in range(4)]
        work = cv.Repair(initials, faults, after)
        assert work.cost[:4].tolist() == np.minimum(table[:, end], cv.FAR).tolist()
        assert all(work.path(s)[2] == end for s in range(4) if work.cost[s] < cv.FAR)


def test_long_conversation_in_one_block(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"Turn {t}.") for t in range(900)]
    found = got(cv.repair(frame(spark, rows)))
    assert found == got(cv.repair(frame(spark, rows), 64))
    assert len(found[0][7]) >= 900 and found[0][1] == 0
