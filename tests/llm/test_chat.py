"""Event logs to formatted conversations, and back."""

from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st

from tempestry.llm import chat

PARTS = st.sampled_from([*chat.CONTROLS, "\\", "\n", "<", "[", "|", "n", "é", "</", "im_end", " "])
TEXTS = st.lists(PARTS, max_size=8).map("".join)


@given(TEXTS)
@settings(deadline=None, max_examples=500)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROLS)


@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=5))
@settings(deadline=None)
def test_parse_reads_what_render_wrote(turns):
    assert list(chat.parse("".join(chat.render(r, t)[0] for r, t in turns))) == turns


def formatted(spark, events):
    return {
        r.conv_id: list(chat.parse(r.formatted))
        for r in chat.format_log(spark.createDataFrame(events, chat.EVENTS)).collect()
    }


def test_deltas_edits_regenerations_and_deletions(spark):
    events = [
        (1, 0, 0, "message", "user", "hello"),
        (1, 1, 1, "message", "assistant", None),
        (1, 1, 2, "delta", "assistant", "a"),
        (1, 1, 3, "delta", "assistant", "b"),
        (1, 2, 4, "message", "user", "lost: the answer before is made anew"),
        (1, 1, 5, "regenerate", "assistant", None),
        (1, 1, 6, "delta", "assistant", "new"),
        (1, 0, 7, "edit", "user", "hello there"),
        (1, 2, 8, "message", "user", "thanks"),
        (1, 3, 9, "message", "assistant", "gone"),
        (1, 3, 10, "delete", None, None),
        (2, 0, 0, "delta", "assistant", "only a delta"),
        (None, 0, 0, "message", None, None),
    ]
    for log in (events, events[::-1]):
        assert formatted(spark, log) == {
            1: [("user", "hello there"), ("assistant", "new"), ("user", "thanks")],
            2: [("assistant", "only a delta")],
            None: [("", "")],
        }


def test_rows_round_trip(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE_TURNS", 2)
    long = "ü</s>" * 700
    rows = [
        (7, 0, "system", "be brief", "x"),
        (7, 1, "user", None, "x"),
        (7, 2, "assistant", long, "x"),
        (7, 2, "assistant", long, "x"),
        (7, 4, "assistant", "", "x"),
        (8, None, None, "<|im_end|>\n<|im_start|>user\n", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, event string")
    events = chat.events_of_rows(df.unionByName(chat.control_sample(spark), allowMissingColumns=True))
    got = {r.conv_id: r for r in chat.read_back(chat.format_log(events)).collect()}
    assert set(got) == {7, 8, -1}
    turns = [("system", "be brief"), ("user", ""), ("assistant", ""), ("assistant", long), ("assistant", long)]
    order = [turns[0], turns[1], turns[3], turns[4], turns[2]]
    assert got[7].n_turns == 5 and got[7].loss_chars == 2 * len(long)
    assert got[7].turns_sha256 == sha256("".join(f"{r}\n{t}\n" for r, t in order).encode()).hexdigest()
    assert got[7].loss_sha256 == sha256((long + long).encode()).hexdigest()
    assert got[8].n_turns == 1 and got[8].loss_chars == 0 and got[8].loss_sha256 == sha256(b"").hexdigest()
    assert got[-1].n_turns == 2 and got[-1].loss_chars == 21


def test_log_of_rows_has_a_history_that_folds_away(spark):
    rows = [(c, t, ("user", "assistant", None)[t % 3], f"text {t} " * 9) for c in (1, None) for t in range(9)]
    events = chat.events_of_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    log = [tuple(r) for r in events.collect()]
    assert {e[3] for e in log} == {"message", "delta", "edit", "regenerate", "delete"}
    # Some message was begun before an earlier one was regenerated.
    cuts = [e for e in log if e[3] == "regenerate"]
    assert any(e[0] == c[0] and e[1] > c[1] and e[2] < c[2] for e in log for c in cuts)
    log.sort(key=lambda e: (e[0] or 0, *e[1:3]))
    assert [(c, role, text) for c, _, role, text in chat.fold(iter(log))] == [(c, r or "", x) for c, _, r, x in sorted(rows, key=lambda r: r[0] or 0)]


def test_empty_log(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_log(chat.events_of_rows(rows))).count() == 0
