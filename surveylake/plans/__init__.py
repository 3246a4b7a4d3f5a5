"""The layers as plans: silver, the six gold tables, and the reports over them."""
