"""Texts that operators must stand."""

ODD = [None, "", " \t\n ", "word", "one two three four", "a b c d e", "a b c d e", "A B  C\td e", "x" * 30_000, "long words " * 4000, "\n\n\n", "ünï çödé 日本語 ١٢٣", "<|endoftext|> x <|endoftext|>", "don't we'll", "BM RIFF PK\x03\x04 ftyp", "   lead and trail   "]
