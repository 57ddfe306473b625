"""Columns with names that the operators use themselves."""

#: Names that operators use inside; each holds a 7 in ``odd``.
CLASHING = (
    "id", "shard", "depth", "bucket", "kept", "rep", "_hash", "_bytes", "size", "start", "words", "_stats", "n", "removed", "component",
    "row", "_id", "_d", "_s", "_n", "_text", "_doc", "_size", "_source", "_copies", "_copy", "_nth", "_times", "_gone", "_prefix", "_found", "_at",
)


def unharmed(df, *replaced):
    """That every clashing column still holds its 7, but for those that an operator says it replaces."""
    names = [c for c in CLASHING if c not in replaced]
    return df.select(*names).distinct().collect() in ([], [(7,) * len(names)])
