"""Chat formatting of reply trees.

Rows are messages with a tree, an id in it and the id of the message they answer. Self-joins
enumerate the paths from roots to leaves: in round k every message knows its ancestor 2^k
replies up, and every path, which begins as its leaf alone, takes in the ancestors 2^k above
those it has. So the number of rounds is the logarithm of the longest path, rows carry ids
only, and texts are joined once at the end. Paths are ranked in their tree by the sum of
their messages' scores, and each chosen one is formatted as one conversation:

    <|im_start|>role
    text<|im_end|>

Control strings in roles and texts are escaped reversibly: `%` becomes `%25`, then `<|`
becomes `%3C|`. The loss mask lists the assistant texts' places in the formatted string, in
code points.

Built-in functions only. A message whose parent is null or absent is a root. Messages that
answer each other in a circle have no root; they, and answers to them, stand in no path. A null text or role is the
empty string. Rows with a null tree form a tree of their own. Ids must be unique in a tree;
of repeated ones the smallest (role, text) stays. An empty table gives no conversations.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowatlas.llm.common import cut_lineage

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%3C"), F.lit("<")), F.lit("%25"), F.lit("%"))


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): every message of every path, `up` replies above the leaf.

    `nodes` has tree, node and parent, unique by tree and node, no nulls but in parent.
    """
    known = nodes.select("tree", F.col("node").alias("parent"))
    answers = nodes.filter("parent IS NOT NULL").join(known, ["tree", "parent"], "left_semi")
    jumps = [cut_lineage(answers.select("tree", "node", F.col("parent").alias("above")))]
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    # jumps[k]: the ancestor 2^k replies up; no root is further away than the tree is large
    while jumps[-1].limit(1).count() and 1 << (len(jumps) - 1) < largest:
        after = jumps[-1].select("tree", F.col("node").alias("above"), F.col("above").alias("next"))
        step = jumps[-1].join(after, ["tree", "above"]).select("tree", "node", F.col("next").alias("above"))
        jumps.append(cut_lineage(step))
    # who has an ancestor as many replies up as the tree has messages has come upon a circle
    lost = jumps.pop().select("tree", "node")
    answered = answers.select("tree", F.col("parent").alias("node")).distinct()
    leaves = nodes.join(answered, ["tree", "node"], "left_anti").join(lost, ["tree", "node"], "left_anti")
    members = cut_lineage(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up")))
    for k, jump in enumerate(jumps):
        more = members.join(jump, ["tree", "node"])
        grown = more.select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        members = cut_lineage(members.unionAll(grown))
    return members


def conversations(
    messages: DataFrame,
    tree: str = "tree",
    node: str = "node",
    parent: str = "parent",
    role: str = "role",
    text: str = "text",
    score: str | None = None,
    best: int | None = None,
    trained_role: str = "assistant",
) -> DataFrame:
    """One row for each chosen path: tree, leaf, score, rank, n_turns, formatted, loss_spans.

    `best` keeps the first so many paths of a tree by score (ties: by leaf); None keeps all.
    loss_spans are (begin, end) of the texts of `trained_role`, in order.
    """
    value = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    columns = {
        "tree": F.col(tree), "node": F.col(node), "parent": F.col(parent),
        "role": escape(F.coalesce(F.col(role), F.lit(""))), "text": escape(F.coalesce(F.col(text), F.lit(""))),
        "score": value,
    }
    rows = messages.select(*[c.alias(k) for k, c in columns.items()]).filter("node IS NOT NULL")
    # a null tree joins as one of its own
    rows = rows.withColumn("tree", F.struct(F.col("tree").isNull().alias("none"), F.col("tree").alias("id")))
    first = F.min(F.struct("role", "text", "parent", "score")).alias("m")
    rows = cut_lineage(rows.groupBy("tree", "node").agg(first).select("tree", "node", "m.*"))
    member = paths(rows.select("tree", "node", "parent"))
    scored = member.join(rows.select("tree", "node", "score"), ["tree", "node"])
    ranked = scored.groupBy("tree", "leaf").agg(F.sum("score").alias("score"), F.count("*").alias("n_turns"))
    order = Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf")
    if best is not None:
        ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    else:
        ranked = ranked.withColumn("rank", F.row_number().over(order))
    chosen = member.join(ranked.select("tree", "leaf"), ["tree", "leaf"], "left_semi")
    turns = chosen.join(rows.select("tree", "node", "role", "text"), ["tree", "node"])
    head = F.concat(F.lit(START), "role", F.lit("\n"))
    turns = turns.select("tree", "leaf", "up", "role", F.length("text").alias("size"), F.length(head).alias("lead"),
                         F.concat(head, "text", F.lit(END)).alias("turn"))
    # where each text begins in its conversation: lengths summed from the root down
    above = Window.partitionBy("tree", "leaf").orderBy(F.col("up").desc()).rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("at", F.coalesce(F.sum(F.length("turn")).over(above), F.lit(0)) + F.col("lead"))
    listed = F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("k"), "turn", "role", "at", "size")))
    built = placed.groupBy("tree", "leaf").agg(listed.alias("turns"))
    trained = F.filter("turns", lambda t: t["role"] == trained_role)
    spans = F.transform(trained, lambda t: F.struct(t["at"].alias("begin"), (t["at"] + t["size"]).alias("end")))
    formatted = F.array_join(F.transform("turns", lambda t: t["turn"]), "")
    built = built.select("tree", "leaf", formatted.alias("formatted"), spans.alias("loss_spans"))
    return built.join(ranked, ["tree", "leaf"]).select(
        F.col("tree.id").alias("tree"), "leaf", "score", "rank", "n_turns", "formatted", "loss_spans"
    )


def read_back(formatted: Column, loss_spans: Column) -> Column:
    """turns (role, text) of a formatted conversation, and the text under its loss mask, unescaped."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, "\n")
        return F.struct(
            unescape(F.substring(piece, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substring(piece, cut + 1, F.length(piece) - cut - len(END))).alias("text"),
        )

    under = F.transform(loss_spans, lambda s: unescape(F.substring(formatted, (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int"))))
    return F.struct(F.transform(pieces, turn).alias("turns"), F.array_join(under, "").alias("loss"))
