"""What several test modules use."""


def rows(df):
    return [tuple(r) for r in df.collect()]
