"""Energy-market and bank-liquidity analytics as lazy Spark DataFrames."""
