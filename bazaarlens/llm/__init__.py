"""Training-data operators: dealt queries op1 to op10. Nothing else in the
library imports this subpackage."""
