"""Segmentation against all segmentations, exact round trips, reversible chat templates."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import chat, pieces
from tidelog.llm.pieces import Segmenter, cheapest, encode_documents, load_vocabulary


@pytest.fixture(scope="module")
def own():
    return Segmenter(load_vocabulary())


def every(own, part):
    """Scores of all segmentations of a part, best first."""
    ends = own.lattice(part)
    scores = {0: [0]}
    for end in range(1, len(ends)):
        scores[end] = [s + t for start, s, _ in ends[end] for t in scores[start]]
    return sorted(scores[len(part)], reverse=True)


@pytest.mark.parametrize("part", [" hello", "  the", "ation", " 日本", "▁x", "\n", " aaaa", "é"])
def test_best_against_all(own, part):
    wanted = every(own, part)
    assert [s for s, _ in own.best(part, 6)] == wanted[:6]
    score, ids, second = own._two_best(part)
    assert score == wanted[0] and own.best(part, 1)[0][0] == score
    assert second == wanted[0] - wanted[1] if len(wanted) > 1 else second >= 1 << 60


def test_text_against_all(own):
    for text in ("the cat", "a b", "one\ntwo"):
        wanted = every(own, " " + text)
        ids, found = own.encode(text, 5)
        assert [s for s, _ in found] == wanted[:5]
        for score, changes in found:
            out = ids.tolist()
            for first, n, instead in reversed(changes):
                out[first:first + n] = instead
            assert own.decode(out) == text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_round_trip(own, text):
    if "\ud800" <= max(text, default="") <= "\udfff":
        return
    assert own.decode(own.encode(text, 3)[0].tolist()) == text


def test_parts_are_taken_over_between_generations(own, monkeypatch):
    texts = [f"word{i % 7} other{i} Ünï{i % 3}" for i in range(30)]
    wanted = [own.encode(t, 3) for t in texts]
    monkeypatch.setattr("tidelog.llm.pieces.PARTS_KEPT", 5)
    small = Segmenter(own.vocabulary)
    for t, (ids, found) in zip(texts, wanted):
        got = small.encode(t, 3)
        assert got[0].tolist() == ids.tolist() and got[1] == found and len(small.rows) <= 5 + len(t.split())


def test_cheapest_against_all():
    rng = random.Random(5)
    costs = [[0, *sorted(rng.randint(0, 9) for _ in range(3))] for _ in range(4)]
    import itertools
    wanted = sorted(sum(c) for c in itertools.product(*costs))
    assert [c for c, _ in cheapest(costs, 12)] == wanted[:12]


def test_encode_documents(spark):
    docs = spark.createDataFrame([(1, None, 1), (None, "", 1), (3, "x" * 50_000, 1), (3, "x" * 50_000, 1), (4, "▁ \n", 1)], "doc_id bigint, text string, ids int")
    rows = encode_documents(docs).collect()
    assert len(rows) == 5 and all(r["decodes"] for r in rows)
    assert [r["nbest"][0]["score"] for r in rows if not r["ids"]] == [0.0, 0.0]
    assert encode_documents(docs.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<|\\im_startend>\nab: ", max_size=40), st.text(alphabet="<|\\\nab", max_size=8))
def test_turns_read_back(text, role):
    formatted, start, end, _, _ = chat.format_turn(role, [{"kind": "text", "text": text, "ref": None, "tokens": None}], role)
    assert chat.read_turn(formatted) == (role, text)
    assert chat.unescape(formatted[start:end]) == text
    assert formatted.count("<|") == 2


def test_parts_read_back():
    parts = [{"kind": "text", "text": "see <|image:0|> ", "ref": None, "tokens": None},
             {"kind": "image", "text": None, "ref": "a.png", "tokens": None}, {"kind": "audio", "text": None, "ref": "b.wav", "tokens": 9},
             {"kind": "document", "text": None, "ref": None, "tokens": None}, {"kind": "text", "text": "end", "ref": None, "tokens": None}]
    formatted, start, end, attached, tokens = chat.format_turn("user", parts)
    assert start == end and tokens == 256 + 9 + 512
    assert [formatted[a["at"]:].startswith(f"<|{a['kind']}:{i}|>") for i, a in enumerate(attached)] == [True] * 3
    back = chat.read_parts(formatted, attached)
    assert [(p["kind"], p["text"], p["ref"]) for p in back] == [(p["kind"], p["text"], p["ref"]) for p in parts]
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"kind": "video", "text": None, "ref": None, "tokens": None}])


def test_conversations(spark):
    part = f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>, loss_start string"
    text = lambda t: [("text", t, None, None)]
    turns = spark.createDataFrame([(1, 1, "assistant", text("yes"), "x"), (1, 0, "user", text(None), "x"), (None, 0, None, None, "x"),
                                   (2, None, "assistant", text("a"), "x"), (2, None, "assistant", text("a"), "x")], part)
    rows = {r["conv_id"]: r for r in chat.conversation_digests(chat.format_conversations(turns)).collect()}
    assert {k: (r["n_turns"], r["loss_chars"]) for k, r in rows.items()} == {1: (2, 3), None: (1, 0), 2: (2, 2)}
    assert chat.conversation_digests(chat.format_conversations(turns.limit(0))).count() == 0


def test_parts_side_by_side_equal_the_search(own):
    """Scripts, characters that are no piece, half pairs, long runs: ids, score and cost of the second best."""
    rng = random.Random(4)
    parts = ["".join(rng.choice("ab \u00e9\u4e2d\U0001f600\u0301tion\ud800") for _ in range(rng.randint(1, 30))) for _ in range(800)]
    parts = list(dict.fromkeys([*parts, "\n", " ", " " * 40, "a" * 48, " the", " internationalisation"]))
    length, score, cost, ids = own.edges.search(parts)
    ends = np.cumsum(length)
    assert ends[-1] == len(ids)
    for part, n, s, c, end in zip(parts, length, score, cost, ends):
        found = own.best(part, 2)
        assert found[0] == (s, tuple(ids[end - n:end].tolist()))
        assert c == (found[0][0] - found[1][0] if len(found) > 1 else pieces._NONE)
        assert own._two_best(part) == (s, list(found[0][1]), c)


def test_learning_in_lots_changes_nothing(own, monkeypatch):
    texts = [" ".join(f"word{i * j % 37} \u4e2d{i}" for j in range(30)) + "\n" * (i % 3) + "x" * 60 for i in range(40)] + ["", None]
    own.forget()
    wanted = [own.encode(t, 3) for t in texts]
    monkeypatch.setattr(pieces, "_SIDE_BY_SIDE", 50)
    monkeypatch.setattr(pieces, "PARTS_KEPT", 60)
    own.forget()
    for at in range(0, len(texts), 5):
        own.learn(texts[at:at + 5])
        for t, (ids, found) in zip(texts[at:at + 5], wanted[at:at + 5]):
            got = own.encode(t, 3)
            assert got[0].tolist() == ids.tolist() and got[1] == found
    own.forget()


def test_workers_keep_no_parts_of_an_ended_task(spark):
    """Workers are reused: what the encoding keeps would count in every later stage."""
    def kept(batches):
        import gc

        for batch in batches:
            n = sum(type(o).__name__ == "Segmenter" for o in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(batch), pa.int64())], names=["n"])

    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(64)], "doc_id bigint, text string").repartition(8)
    assert encode_documents(docs).filter("decodes").count() == 64
    assert spark.range(64, numPartitions=8).mapInArrow(kept, "n bigint").agg({"n": "max"}).first()[0] == 0
