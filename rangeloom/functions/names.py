"""Column names in SQL text."""


def quoted(name: str) -> str:
    """A column name as Spark SQL takes it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
