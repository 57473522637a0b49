"""DataFrame operators: pure functions of frames, with the clock passed in."""
