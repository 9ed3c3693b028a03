"""Reading the register and writing its reports."""
