"""tablegrad: tensor operators, gradients and data-parallel training as Spark DataFrame plans."""

__version__ = "0.1.0"
