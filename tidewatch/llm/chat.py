"""Chat formatting by a declarative template (operator 8), in DataFrame functions only.

A finite-state machine over roles judges the order of turns. Every turn becomes three segments: mark, text, mark; only the
text of a role that the template trains on carries the loss flag. Control strings inside texts and role names get a
backslash after their first character (further ones if some follow already), so none stands in a text, and reading back
removes exactly one. All conversations are formatted; ``valid`` says whether their order of roles is allowed.

Defined results: a null text is empty and a null role is an empty name; turns of equal number are ordered by role, then
text; a null turn comes first; a null conversation id is a conversation of its own; repeated rows are repeated turns; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import staged

#: The template: marks before and after the text of a role, and whether its text is trained on. Other roles use OTHER,
#: whose first mark is closed by ROLE_END after the role's name.
TEMPLATE = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n", False),
    "user": ("[INST] ", " [/INST]\n", False),
    "assistant": ("<s> ", " </s>\n", True),
}
OTHER, ROLE_END, OTHER_END = "[ROLE]", "[/ROLE] ", " [END]\n"
CONTROL = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[END]"]
#: Allowed orders: state -> role -> next state. Any state but the first may end a conversation after an assistant turn.
STATES = {"start": {"system": "told", "user": "asked"}, "told": {"user": "asked"}, "asked": {"assistant": "answered"}, "answered": {"user": "asked"}}
FINAL = ["answered"]


def _quoted(text: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() and c not in "\n " else c for c in text)


#: What may follow the first character of a control string, behind any number of backslashes.
_FOLLOWS = {first: "(?=\\\\*(?:" + "|".join(_quoted(c[1:]) for c in CONTROL if c[0] == first) + "))" for first in dict.fromkeys(c[0] for c in CONTROL)}
#: A first character that such text follows; a backslash between the two. Both start with fixed characters, which is quick.
_PLACE = "|".join(_quoted(first) + follows for first, follows in _FOLLOWS.items())
_SLASH = "\\\\(?:" + "|".join(f"(?<={_quoted(first)}\\\\){follows}" for first, follows in _FOLLOWS.items()) + ")"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_PLACE), F.lit("$0\\\\"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_SLASH), F.lit(""))


def _by_role(role: Column, pick, other: Column) -> Column:
    return reduce(lambda rest, item: F.when(role == item[0], F.lit(pick(item[1]))).otherwise(rest), TEMPLATE.items(), other)


def valid_order(roles: Column) -> Column:
    """Run the machine over the roles; an unknown step leads nowhere."""
    def step(state: Column, role: Column) -> Column:
        moves = [(a, r, b) for a, by in STATES.items() for r, b in by.items()]
        return reduce(lambda rest, m: F.when((state == m[0]) & (role == m[1]), F.lit(m[2])).otherwise(rest), moves, F.lit("none"))

    return F.aggregate(roles, F.lit("start"), step).isin(FINAL)


def formatted(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``valid``, and ``segments``: text and loss flag of every piece, in order."""
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def pieces(t: Column) -> Column:
        before = _by_role(t["role"], lambda x: x[0], F.concat(F.lit(OTHER), escaped(t["role"]), F.lit(ROLE_END)))
        after = _by_role(t["role"], lambda x: x[1], F.lit(OTHER_END))
        loss = _by_role(t["role"], lambda x: x[2], F.lit(False))
        return F.array(*[F.struct(text.alias("text"), flag.alias("loss")) for text, flag in ((before, F.lit(False)), (escaped(t["text"]), loss), (after, F.lit(False)))])

    return rows.select("conv_id", valid_order(F.transform("turns", lambda t: t["role"])).alias("valid"), F.flatten(F.transform("turns", pieces)).alias("segments"))


def written(turns: DataFrame) -> DataFrame:
    """The formatted conversations, written to the shared folder and read back."""
    return staged(formatted(turns), "chat")


_MARKS = [(role, before, after) for role, (before, after, _) in TEMPLATE.items()]
_TURN = "(?s)" + "|".join([f"{_quoted(b)}.*?{_quoted(a)}" for _, b, a in _MARKS] + [f"{_quoted(OTHER)}.*?{_quoted(ROLE_END)}.*?{_quoted(OTHER_END)}"])


def read_turns(text: Column) -> Column:
    """Turns (role, text) of a formatted conversation, found by their marks alone."""
    def one(t: Column) -> Column:
        name = F.substring_index(F.substr(t, F.lit(len(OTHER) + 1)), ROLE_END, 1)
        rest = F.substr(t, F.length(name) + len(OTHER) + len(ROLE_END) + 1)
        out = F.struct(unescaped(name).alias("role"), unescaped(F.substr(rest, F.lit(1), F.length(rest) - len(OTHER_END))).alias("text"))
        for role, before, after in _MARKS:
            body = F.substr(t, F.lit(len(before) + 1), F.length(t) - len(before) - len(after))
            out = F.when(F.startswith(t, F.lit(before)), F.struct(F.lit(role).alias("role"), unescaped(body).alias("text"))).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(text, F.lit(_TURN), F.lit(0)), one)


def digests(conversations: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, from the text and the mask that were written."""
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    read = conversations.select("conv_id", "valid", "segments", whole.alias("whole")).withColumn("read", read_turns(F.col("whole")))
    trained = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
    turns = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(trained).cast("long").alias("loss_chars"), F.sha2(trained.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("whole").cast("long").alias("formatted_chars"), "valid")
