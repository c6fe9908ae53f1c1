"""What tests share."""

SF = "/root/testdata/sf0.001"


def rows(frame, columns=None):
    """A frame's rows as sorted text, whatever engine it comes from; nulls are alike."""
    columns = columns or sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(map(str, plain.itertuples(index=False, name=None)))
