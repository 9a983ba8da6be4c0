"""Source mixing and preference formatting."""

import random
import re

import pytest

import corpus_pipeline
from loanlens.llm.chat_preference import ChatTemplate, format_preferences, neighbour_pairs, preference_report
from loanlens.llm.mixing import mix_sources, source_targets


def targets_by_rounds(sizes, weights=(5, 2, 1), share=1.5):
    """Share by weight, cap, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    goal, capped = share * sum(sizes.values()), {}
    while True:
        rest = goal - sum(capped.values())
        open_w = sum(w[s] for s in names if s not in capped)
        level = {s: rest * w[s] / open_w for s in names if s not in capped}
        over = [s for s in level if level[s] > 2 * sizes[s]]
        if not over:
            return {**capped, **level}
        capped |= {s: 2.0 * sizes[s] for s in over}


def mixed(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, s, 5) for i, t, s in rows], "doc_id long, text string, source string, size int")
    return mix_sources(df.repartition(4), **kw).collect()


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    out = []
    for i in range(900):
        source = "hot" if r.random() < 0.35 else r.choice(["a", "b", "ä", "z", None, "tiny" if i < 40 else "b"])
        out.append((i, " ".join(["w"] * int(r.expovariate(1 / 120))), source))
    return out + [(5000, None, "a"), (5001, "", "new"), (None, "one two", "a"), (7, "x", "a"), (7, "x", "a"),
                  (5002, "w " * 20_000, "b")]


def test_targets_equal_repeated_sharing(spark, rows):
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets_by_rounds({s: n for s, n in sizes.items()})
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mix_meets_targets_and_limits(spark, rows):
    out = mixed(spark, rows)
    assert len(out) == len(rows)
    by = {}
    for r in out:
        assert 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    for source, group in by.items():
        target, total = group[0].target, sum(r.size for r in group)
        assert group[0].source_size == total
        assert abs(sum(r.taken for r in group) - target) <= 0.5, source
    again = sorted(mixed(spark, rows[::-1]), key=str)
    assert again == sorted(out, key=str)  # reruns and other layouts agree


def test_mix_edge_cases(spark):
    assert mixed(spark, []) == []
    assert [(r.size, r.target, r.taken) for r in mixed(spark, [(1, None, None), (2, "", "a")])] in (
        [(0, 0.0, 0)] * 2,)
    one = mixed(spark, [(1, "a b c", None)], block_words=1)
    assert [(r.size, r.source_size, r.target) for r in one] == [(3, 3, 4.5)] and one[0].taken in (4, 5)


def check_exact(out, max_repeats=2):
    by = {}
    for r in out:
        assert 0 <= r.taken <= max_repeats * r.size
        by.setdefault(r.source, []).append(r)
    for source, group in by.items():
        assert abs(sum(r.taken for r in group) - group[0].target) <= 0.5, source
        full = int(group[0].target + 0.5) // max(1, group[0].source_size)
        assert all(r.taken >= full * r.size for r in group)
        assert sum(full * r.size < r.taken < (full + 1) * r.size for r in group) <= 1  # one document is cut
    return by


@pytest.mark.parametrize("low, high", [(20, 500), (5, 60), (1, 3)])
def test_small_sources_beside_a_hot_one_meet_their_targets(spark, low, high):
    r = random.Random(high)
    rows = [(k, "w " * 1000, "hot") for k in range(1000)]
    rows += [(2000 + k, " ".join(["w"] * r.randint(low, high)), f"s{k % 300:03d}") for k in range(600)]
    by = check_exact(mixed(spark, rows))
    assert len(by) == 301 and all(sum(x.taken for x in g) > 0 for g in by.values())


def test_mix_of_odd_rows(spark, rows):
    out = mixed(spark, rows)
    assert len(out) == len(rows)
    check_exact(out)
    assert sorted(mixed(spark, rows[::-1]), key=str) == sorted(out, key=str)
    check_exact(mixed(spark, rows, share=4.2, max_repeats=5), 5)
    assert mixed(spark, []) == []
    assert [(r.size, r.target, r.taken) for r in mixed(spark, [(1, None, None), (2, "", "a")])] == [(0, 0.0, 0)] * 2


def test_the_pipeline_mixes_to_the_word(spark):
    rows = [(k, "w " * 1000, "hot") for k in range(40)] + [(100 + k, "a b c", f"s{k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    by = check_exact(corpus_pipeline.mix(spark, docs, "").collect())
    assert len(by) == 21


def plain_preference(chosen, rejected, t=ChatTemplate()):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1

    def render(turns):
        text, loss = "", []
        for role, body in turns:
            head = t.begin + (role or "unknown") + t.after_role
            piece = head + (body or "") + t.end
            if role == t.loss_role:
                loss.append((len(text) + len(head), len(text) + len(piece)))
            text += piece
        return text, loss
    return n, render(chosen[:n])[0], *render(chosen[n:]), *render(rejected[n:])


CHATS = {
    0: [("user", "hi"), ("assistant", "hello"), ("user", "bye"), ("assistant", "ok")],
    1: [("user", "hi"), ("assistant", "hello"), ("user", "bye"), ("assistant", "no"), ("user", "x")],
    2: [("user", "same"), ("assistant", "same")], 3: [("user", "same"), ("assistant", "same")],
    4: [("user", None), (None, "é"), ("assistant", "")], 5: [("user", None), (None, "é"), ("user", "")],
    6: [("user", "alone"), ("assistant", "yes")],
    8: [("user", "a")] * 3, 9: [("user", "a")] * 2,
    10: [("user", "long " * 5000)] + [("assistant", str(k)) for k in range(300)],
    11: [("user", "long " * 5000)] + [("assistant", str(k)) for k in range(299)],
}


def test_preferences_match_plain_formatting(spark):
    rows = [(c, k, role, body, "x") for c, turns in CHATS.items() for k, (role, body) in enumerate(turns)]
    rows += [(None, 0, "user", "lost", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, prompt string").repartition(5)
    got = {r.pair_id: r for r in format_preferences(neighbour_pairs(df), df).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4, 5]
    for pair, r in got.items():
        n, prompt, c, cl, j, jl = plain_preference(CHATS.get(2 * pair, []), CHATS.get(2 * pair + 1, []))
        assert (r.n_common, r.prompt, r.chosen, r.rejected) == (n, prompt, c, j)
        assert [tuple(x) for x in r.chosen_loss] == cl and [tuple(x) for x in r.rejected_loss] == jl
    assert got[3].rejected_id is None and got[0].n_common == 3 and got[1].chosen == ""
    assert re.fullmatch(r"(\d+:\d+,?)+", preference_report(neighbour_pairs(df), df).where("pair_id = 5").first().chosen_loss)
    assert format_preferences(neighbour_pairs(df.limit(0)), df.limit(0)).collect() == []


def test_any_pair_table(spark):
    df = spark.createDataFrame([(7, 0, "user", "q"), (9, 0, "user", "q"), (7, 1, "assistant", "a"), (9, 1, "assistant", "b")],
                               "conv_id long, turn long, role string, text string")
    pairs = spark.createDataFrame([("p", 9, 7)], "pair_id string, chosen_id long, rejected_id long")
    r = format_preferences(pairs, df).first()
    assert r.n_common == 1 and "b" in r.chosen and "a" in r.rejected


def test_a_pair_without_turns_stays(spark):
    pairs = spark.createDataFrame([(1, 4, 5), (2, 8, 9)], "pair_id long, chosen_id long, rejected_id long")
    turns = spark.createDataFrame([(8, 0, "user", "hi")], "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in preference_report(pairs, turns).collect()}
    assert sorted(got) == [1, 2]
    assert (got[1].n_common, got[1].prompt, got[1].chosen, got[1].rejected, got[1].chosen_loss) == (0, "", "", "", "")


def test_every_slot_reads_one_block_and_all_blocks_make_the_target(spark):
    from loanlens.llm.mixing import blocks_read, schedule

    sizes = spark.createDataFrame([("a", 9_000), ("b", 40), ("c", 3), ("d", 1)], "source string, size long")
    targets = source_targets(sizes).cache()
    slots = schedule(targets, 1.5 * 9_044, 64).cache()
    per = {r.src: r.n for r in slots.groupBy("src").count().withColumnRenamed("count", "n").collect()}
    assert set(per) == {0, 1, 2, 3} and per[0] > 100
    for src, n in per.items():       # ranks are 0, 1, 2, ...
        assert sorted(r.pick for r in slots.where(f"src = {src}").collect()) == list(range(n))
    words = {r.src: r.w for r in blocks_read(slots, targets).selectExpr("src", "end - begin AS w").groupBy("src").sum("w")
             .withColumnRenamed("sum(w)", "w").collect()}
    assert words == {r.src: int(r.target + 0.5) for r in targets.collect()}
