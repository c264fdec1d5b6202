"""Scalar building blocks (Column -> Column), all JVM-side."""
