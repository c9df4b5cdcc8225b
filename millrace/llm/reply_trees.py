"""Chat formatting over reply trees (operator 11), DataFrame functions only.

*Paths.* Messages point to the message they answer. Self-joins double the reach of these pointers
round by round: after round r a message knows its ancestor 2^r replies up, the replies on the way
and the sum of their scores; a round is stored, and there are as many as the deepest tree's depth
has binary digits. A leaf then knows its whole branch without one row per ancestor. Branches of
a tree are ranked by their mean score, and only the chosen leaves are expanded: going back
through the stored rounds, every row of a path also yields the ancestor 2^r up, so each message
of a path comes out once. Messages with very many replies are only looked up, never gathered.

*Template.* A turn is `### role: text</turn>` and a line feed. Inside texts and roles a backslash
is doubled, then `###` becomes `\\h`, `</turn>` becomes `\\t` and, in roles, `:` becomes `\\c`; so no
control string is left in them, and reading backwards is exact. The loss mask is run-length
coded: for each turn the code points before the masked ones (from the turn's begin) and the
masked ones, which are the escaped text of assistant turns and none of others.

Defined cases: null texts and roles are empty; a null tree is a tree like any other; a message
whose parent is not in its tree starts a conversation of its own; of several rows with one id,
that with the smallest parent, role and text counts; a null id is an id, answered by nobody;
messages on a ring, or answering one, are on no path from a root and go; an empty table gives no
conversations. A null or NaN score counts as 0; equal branch scores go to the longer branch, then
to the leaf whose id is smaller as text. A formatted conversation is one value of one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.prefix import id_order_bucket, plain_key, rank_in_group
from millrace.session import materialize

OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
LEARNT = "assistant"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, code in (("###", "\\h"), ("</turn>", "\\t"), *([(":", "\\c")] if role else [])):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def unescape(text: Column) -> Column:
    """Backslashes come in pairs from the left, so a code is one that no pair took."""

    def codes(part: Column) -> Column:
        for plain, code in (("###", "\\h"), ("</turn>", "\\t"), (":", "\\c")):
            part = F.replace(part, F.lit(code), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), codes), "\\")


def conversation_trees(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as trees with one branch: every row answers the one before it. Equal turns
    are ordered by role and text; rows without a turn come first."""
    rows = turns.select(F.col(key).alias("tree"), F.col(order).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    by = [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    placed = rank_in_group(rows, ["tree"], by, id_order_bucket(F.col("turn"), 4096), "node")
    parent = F.when(F.col("node") > 0, F.col("node") - 1)
    return placed.select("tree", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def reach(messages: DataFrame) -> list[DataFrame]:
    """The rounds: t, n, up (ancestor 2^r replies up, else null), replies and total (score) on the
    way to it, or to the root."""
    own = messages.select("t", "n", "p", "score")
    known = messages.select(F.col("t").alias("kt"), F.col("n").alias("kn"))
    met = own.where("p is not null").join(known, (F.col("t") == F.col("kt")) & (F.col("p") == F.col("kn")), "left")
    step = met.select("t", "n", F.col("kn").alias("up"), F.when(F.col("kn").isNotNull(), 1).otherwise(0).cast("long").alias("replies"), F.col("score").alias("total"))
    roots = own.where("p is null").select("t", "n", F.lit(None).cast("string"), F.lit(0).cast("long"), "score")
    rounds, open_before = [materialize(step.union(roots), "replies")], None
    while True:
        last = rounds[-1]
        open_ = last.where("up is not null")
        left = open_.count()
        if left in (0, open_before):  # the same rows again: rings
            return rounds
        open_before = left
        far = last.select(F.col("t").alias("ft"), F.col("n").alias("fn"), F.col("up").alias("fup"), F.col("replies").alias("fr"), F.col("total").alias("ftotal"))
        moved = open_.join(far, (F.col("t") == F.col("ft")) & (F.col("up") == F.col("fn")))
        moved = moved.select("t", "n", F.col("fup").alias("up"), (F.col("replies") + F.col("fr")).alias("replies"), (F.col("total") + F.col("ftotal")).alias("total"))
        rounds.append(materialize(moved.union(last.where("up is null")), "replies"))


def chosen_paths(rounds: list[DataFrame], keep: int) -> DataFrame:
    """t, leaf, rank, branch_score, place (from the root) and n of the messages of the chosen branches."""
    first, last = rounds[0], rounds[-1]
    answered = first.where("up is not null").select(F.col("t").alias("at"), F.col("up").alias("an")).distinct()
    leaves = last.where("up is null").join(answered, (F.col("t") == F.col("at")) & (F.col("n") == F.col("an")), "left_anti")
    score = F.col("total") / (F.col("replies") + 1)
    best = Window.partitionBy("t").orderBy(F.col("branch_score").desc(), F.col("replies").desc(), "n")
    ranked = leaves.withColumn("branch_score", score).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    path = ranked.select("t", F.col("n").alias("leaf"), "rank", "branch_score", F.col("replies").alias("place"), "n")
    for r in reversed(range(len(rounds) - 1)):
        far = rounds[r].where("up is not null").select(F.col("t").alias("ft"), F.col("n").alias("fn"), F.col("up").alias("fup"))
        met = path.join(far, (F.col("t") == F.col("ft")) & (F.col("n") == F.col("fn")), "left")
        both = F.array(F.struct("place", "n"), F.struct((F.col("place") - 2**r).alias("place"), F.col("fup").alias("n")))
        path = met.select("t", "leaf", "rank", "branch_score", F.explode(F.filter(both, lambda x: x["n"].isNotNull())).alias("x")).select("t", "leaf", "rank", "branch_score", "x.*")
    return path


def format_trees(messages: DataFrame, keep: int = 1, tree: str = "tree", node: str = "node", parent: str = "parent", role: str = "role", text: str = "text", score: str = "score") -> DataFrame:
    """The stored conversations of the `keep` best branches of each tree: tree, rank,
    branch_score, formatted, loss (array of skip, length by turn)."""
    score_ = F.coalesce(F.nanvl(F.col(score).cast("double"), F.lit(0.0)), F.lit(0.0))
    given = messages.select(F.col(tree).alias("tree"), F.struct(F.col(parent).alias("parent"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"), score_.alias("score")).alias("m"), F.col(node).alias("node"))
    given = given.withColumns({"t": plain_key("tree"), "n": plain_key("node")}).groupBy("t", "n").agg(F.first("tree").alias("tree"), F.min("m").alias("m"))
    given = given.select("t", "n", "tree", F.when(F.col("m.parent").isNotNull(), F.concat(F.lit("="), F.col("m.parent").cast("string"))).alias("p"), "m.role", "m.text", "m.score")
    given = materialize(given, "messages")
    paths = chosen_paths(reach(given), keep)

    role_, text_ = escape(F.coalesce("role", F.lit("")), role=True), escape(F.coalesce("text", F.lit("")))
    learnt = F.when(F.col("role") == LEARNT, F.length(text_)).otherwise(0)
    pieces = given.select(
        F.col("t").alias("mt"), F.col("n").alias("mn"), "tree",
        F.concat(F.lit(OPEN), role_, F.lit(BETWEEN), text_, F.lit(CLOSE)).alias("piece"),
        F.struct((F.length(role_) + len(OPEN + BETWEEN)).cast("int").alias("skip"), learnt.cast("int").alias("length")).alias("loss"),
    )
    met = paths.join(pieces, (F.col("t") == F.col("mt")) & (F.col("n") == F.col("mn")))
    whole = met.groupBy("t", "leaf", "rank", "branch_score").agg(F.first("tree").alias("tree"), F.sort_array(F.collect_list(F.struct("place", "piece", "loss"))).alias("turns"))
    out = whole.select("tree", "rank", "branch_score", F.array_join("turns.piece", "").alias("formatted"), F.col("turns.loss").alias("loss"))
    return materialize(out, "conversations")


def read_turns(formatted: Column) -> Column:
    """Array of role and text of the turns of a formatted conversation."""
    turns = F.split(formatted, CLOSE, -1)
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)

    def parts(turn: Column) -> Column:
        body = F.substr(turn, F.lit(len(OPEN) + 1))
        head = F.locate(BETWEEN, body)
        return F.struct(unescape(F.substr(body, F.lit(1), head - 1)).alias("role"), unescape(F.substr(body, head + len(BETWEEN))).alias("text"))

    return F.transform(turns, parts)


def under_mask(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped."""
    masked = F.zip_with(F.split(formatted, CLOSE, -1), loss, lambda turn, m: F.coalesce(F.substr(turn, m["skip"] + 1, m["length"]), F.lit("")))
    return F.array_join(F.transform(masked, unescape), "")


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """What formatted conversations give when they are read again."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = conversations.select("tree", "formatted", read_turns(F.col("formatted")).alias("turns"), under_mask(F.col("formatted"), F.col("loss")).alias("learnt"))
    return read.select(
        "tree", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
