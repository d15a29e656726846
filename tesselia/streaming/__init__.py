"""An addition: run events as a stream."""
