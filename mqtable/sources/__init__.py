"""Message sources: the fixture view, the replayable message log, the Python data source."""
