"""mercato: marketplace analytics (order, product and seller features, unit
economics, what-if, statistics and regression) as Spark DataFrame operators."""
