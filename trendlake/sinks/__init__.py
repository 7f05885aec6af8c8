"""Writers; the only places, with the quality gate, that start jobs."""
