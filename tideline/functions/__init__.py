"""Column expressions: pure, JVM-side, usable in batch and streaming alike."""
