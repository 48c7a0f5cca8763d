"""Rows that every operator must take: nulls, empty and blank texts, ties, repeated rows, one long text."""

ODD = [(1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, "One two\nthree four five", "b"), (5, "ONE two\nthree four five", "b"),
       (5, "ONE two\nthree four five", "b"), (None, "one two\nthree four five", "c"), (None, None, None), (7, "lorem ipsum dolor " * 3000, "a"),
       (8, "été ÉTÉ   x", "c"), (9, "a\x00b <|endoftext|>", "c")]
