"""Plans built from the operators: the warehouse build and the driver queries."""
