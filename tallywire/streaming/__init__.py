"""The same work on a stream: one micro-batch at a time, with state that outlives the process."""
