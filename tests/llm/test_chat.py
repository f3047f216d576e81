import hashlib

from jobweave.llm import chat
from jobweave.llm.queries import HOSTILE, tokenizer_path


def digest(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode()))
    text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rows)
    loss = "".join(r[3] or "" for r in rows if r[2] == "assistant")
    return len(rows), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


HARD = [HOSTILE, "\\", "\\\\### x</turn>", "### ### Assistant: ", "</turn></turn>\n", "", None, "<|endoftext|> é 日本 \n\n  x", "#### a", "a: b", "###", "end \\", "\\n"]


def test_escaping_is_undone():
    for text in HARD:
        for escape in (chat.escape, chat.escape_role):
            out = escape(text or "")
            assert chat.unescape(out) == (text or "")
        bare = chat.escape(text or "").replace("\\\\", "")
        assert "</turn>" not in bare.replace("\\</turn>", "") and "### " not in bare.replace("\\### ", "")


def test_read_back(llm):
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(HARD)]
    rows += [(2, None, None, None), (2, 0, "ass: istant### ", "odd role"), (3, 0, "assistant", "long " * 60_000), (3, 1, "assistant", "b"), (None, 0, "user", "no id")]
    rows += [(4, 1, "user", "same"), (4, 1, "user", "same"), (-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)]
    # rows of one turn: by role, then by text, not by how they are written
    rows += [(5, 0, role, text) for role in ("a b", "a", "a:", "", None) for text in ("### x", "$", "\\", "x</turn>", "x<b", "x\n", "x", "")]
    frame = llm.createDataFrame([(*r, "clash", b"x") for r in rows], "conv_id long, turn long, role string, text string, formatted string, ids binary")
    turns = chat.format_turns(frame, tokenizer_path())
    read = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_conversations(turns, tokenizer_path()).collect()}
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append(r)
    assert read == {k: digest(v) for k, v in by_conv.items()}
    places = turns.where("conv_id = 1").orderBy("seq").collect()
    assert [p["start"] for p in places] == [sum(q["n_ids"] for q in places[:i]) for i in range(len(places))]
    assert all(len(p["mask"]) == p["n_ids"] == len(p["ids"]) // 4 for p in places)


def test_no_rows(llm):
    none = llm.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_conversations(chat.format_turns(none, tokenizer_path()), tokenizer_path()).count() == 0
