"""The report tables: each module turns input frames and ``as_of`` into output frames."""
