"""Names for columns that an operator adds on its way, beside any that its input has."""


def unused(columns: list, *names: str) -> list:
    """The names, with as many underscores in front as none of the columns begins with, whatever
    the case of its letters."""
    taken = {c.lower() for c in columns}
    prefix = "_"
    while any((prefix + name).lower() in taken for name in names):
        prefix += "_"
    return [prefix + name for name in names]
