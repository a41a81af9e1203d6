"""Small helpers that look at rows of results."""


def by(df, key):
    return {row[key]: row for row in df.collect()}
