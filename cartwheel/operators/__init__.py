"""DataFrame -> DataFrame operators; the same code serves batch, replay and streaming."""
