"""Where rows come from and go to: tables, log frames, offsets, sinks."""
