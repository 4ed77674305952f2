def same(df, expected, columns):
    """The rows of a result, in any order, are the expected ones."""
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    want = sorted(expected, key=repr)
    assert len(got) == len(want)
    assert [(a, b) for a, b in zip(got, want) if a != b][:3] == []
